"""Hot-key splitting must not change results: force tiny segments and
compare each segmented operator with the plain single-window SQL form."""

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tablekit.operators import analytics as A
from tablekit.operators import scd2 as S


def test_sessionize_segmented_equals_plain(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    seg = A.sessionize(ev, "user_id", "ts", tie_break=["event_id"], rows_per_segment=3)
    ev.createOrReplaceTempView("ev_small")
    plain = spark.sql("""
        WITH g AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event FROM ev_small),
        f AS (SELECT *, CASE WHEN prev_event IS NULL OR ts - prev_event > INTERVAL 30 MINUTES THEN 1 ELSE 0 END
                 AS new_session FROM g)
        SELECT event_id, prev_event, new_session,
               SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_id FROM f""")
    cols = ("event_id", "prev_event", "new_session", "session_id")
    assert rows(seg, *cols) == rows(plain, *cols)


def test_time_between_segmented(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    a = A.time_between_purchases(o, "o_custkey", "o_orderdate", ["o_orderkey"], rows_per_segment=2)
    b = A.time_between_purchases(o, "o_custkey", "o_orderdate", ["o_orderkey"])
    cols = ("o_orderkey", "previous_purchase", "days_between")
    assert rows(a, *cols) == rows(b, *cols)


def test_scd2_intervals_segmented(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for collapse in (False, True):
        a = S.scd2_intervals(o, "o_custkey", "o_orderpriority", "o_orderdate", tie_break=["o_orderkey"],
                             collapse=collapse, rows_per_segment=2)
        b = S.scd2_intervals(o, "o_custkey", "o_orderpriority", "o_orderdate", tie_break=["o_orderkey"],
                             collapse=collapse, rows_per_segment=10**9)
        assert rows(a) == rows(b)


def test_scd2_overlaps_segmented(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    iv = S.scd2_intervals(o, "o_custkey", "o_orderpriority", "o_orderdate", tie_break=["o_orderkey"])
    iv = iv.withColumn("valid_to", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
                       .otherwise(F.col("valid_to")))
    for mode in ("adjacent", "any"):
        a = S.scd2_overlaps(iv, "o_custkey", "valid_from", "valid_to", mode, tie_break=["o_orderkey"], rows_per_segment=2)
        b = S.scd2_overlaps(iv, "o_custkey", "valid_from", "valid_to", mode, tie_break=["o_orderkey"], rows_per_segment=10**9)
        assert rows(a) == rows(b) and a.count() > 0


def test_hot_null_key_segmented(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    data = [(None if i % 3 else i % 2, t0 + dt.timedelta(minutes=7 * i), i) for i in range(300)]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz, id long")
    a = A.sessionize(df, "u", "t", gap="10 minutes", tie_break=["id"], rows_per_segment=10)
    b = A.sessionize(df, "u", "t", gap="10 minutes", tie_break=["id"], rows_per_segment=10**9)
    cols = ("id", "prev_event", "new_session", "session_id")
    assert rows(a, *cols) == rows(b, *cols)
    sessions_null = {r.session_id for r in a.filter("u is null").collect()}
    assert len(sessions_null) >= 1


def test_null_times_sort_last_segmented_or_not(spark):
    import datetime as dt
    from pyspark.sql import Window
    from tablekit.operators import dedup as D
    t0 = dt.datetime(2024, 1, 1)
    data = [(i % 2, None if i % 9 == 0 else t0 + dt.timedelta(minutes=i), i) for i in range(60)]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz, id long")
    w = Window.partitionBy("u").orderBy(F.col("t").asc_nulls_last(), F.col("id"))
    plain = df.withColumn("previous_purchase", F.lag("t").over(w))
    for rps in (4, 10**9):
        seg = A.time_between_purchases(df, "u", "t", ["id"], rows_per_segment=rps)
        assert rows(seg, "id", "previous_purchase") == rows(plain, "id", "previous_purchase")
    first = D.dedup_keep_first(df.withColumn("k", F.lit(1)), "k", ["t", "id"]).first()
    assert first.t == t0 + dt.timedelta(minutes=1)      # a NULL time is never "earliest"


def test_hot_key_segments_are_equal_count_when_rows_crowd(spark):
    import datetime as dt
    from tablekit.functions.time import epoch_micros
    from tablekit.plans.segments import SEG, segment
    t0 = dt.datetime(2024, 1, 1)
    # 1 row a day for a year, plus 2000 rows within one hour of one day
    data = [(1, t0 + dt.timedelta(days=d)) for d in range(365)]
    data += [(1, t0 + dt.timedelta(days=200, seconds=s)) for s in range(2000)]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz")
    seg = segment(df, ["u"], epoch_micros(df, "t"), rows_per_segment=100)
    sizes = [r["count"] for r in seg.groupBy(SEG).count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 300      # equal-width slices would put ~2000 in one
    a = A.time_between_purchases(df.withColumn("id", F.monotonically_increasing_id()), "u", "t", ["id"],
                                 rows_per_segment=100)
    b = A.time_between_purchases(df.withColumn("id", F.monotonically_increasing_id()), "u", "t", ["id"])
    assert rows(a, "t", "previous_purchase") == rows(b, "t", "previous_purchase")


def test_one_instant_spreads_over_segments(spark):
    """A key whose rows all share one time, some of them whole: several
    segments, and the same chain of values as one window over (time, id)."""
    import datetime as dt
    from tablekit.functions.time import epoch_micros
    from tablekit.plans.segments import SEG, segment
    t0 = dt.datetime(2024, 1, 1)
    data = [(1, t0, i // 5) for i in range(3000)] + [(2, t0 + dt.timedelta(hours=i), i) for i in range(20)] + [(1, None, 7)] * 400
    df = spark.createDataFrame(data, "u long, t timestamp_ntz, id long").repartition(6)
    seg = segment(df, ["u"], epoch_micros(df, "t"), 100, ["id"])
    sizes = [r["count"] for r in seg.filter("u = 1").groupBy(SEG).count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 300 and sum(sizes) == 3400
    a = A.sessionize(df, "u", "t", tie_break=["id"], rows_per_segment=100)
    b = A.sessionize(df, "u", "t", tie_break=["id"], rows_per_segment=10**9)
    cols = ("u", "t", "id", "prev_event", "new_session", "session_id")
    assert rows(a, *cols) == rows(b, *cols)
    iv = spark.createDataFrame([(1, i % 7, t0, t0 + dt.timedelta(days=i % 3), i) for i in range(900)],
                               "k long, a long, f timestamp_ntz, e timestamp_ntz, id long")
    for mode in ("adjacent", "any"):
        x = S.scd2_overlaps(iv, "k", "f", "e", mode, tie_break=["id"], rows_per_segment=50)
        y = S.scd2_overlaps(iv, "k", "f", "e", mode, tie_break=["id"], rows_per_segment=10**9)
        assert rows(x) == rows(y) and x.count() > 0
    x = S.scd2_intervals(iv, "k", "a", "f", tie_break=["id"], collapse=True, rows_per_segment=50)
    y = S.scd2_intervals(iv, "k", "a", "f", tie_break=["id"], collapse=True, rows_per_segment=10**9)
    assert rows(x) == rows(y)


def test_a_burst_inside_one_window_spreads(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    ms = dt.timedelta(milliseconds=1)
    data = [(1, t0 + (i % 700) * ms, i) for i in range(2500)]                    # all inside a second, many ties
    data += [(None, t0 + i * 40_000 * ms, i) for i in range(300)] + [(2, t0, i) for i in range(30)]
    data += [(1, None, i) for i in range(40)] + [(3, None, 1)]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz, events_in_window long").repartition(5)
    for window, least in (("1 second", 1), ("100 milliseconds", 300), ("2 minutes", 3)):
        a = A.burst_events(df, "u", "t", window=window, min_count=least, count_col="n", rows_per_segment=100)
        b = A.burst_events(df, "u", "t", window=window, min_count=least, count_col="n")
        assert rows(a) == rows(b) and a.count() > 0
