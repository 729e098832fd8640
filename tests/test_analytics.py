import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tablekit.operators import analytics as A

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_burst_frame_is_inclusive(spark):
    df = spark.createDataFrame([(1, ts(0)), (1, ts(60)), (1, ts(61))], "u long, t timestamp_ntz")
    out = A.burst_events(df, "u", "t", window="1 minute", min_count=1)
    assert rows(out, "t", "events_in_window") == sorted([(ts(0), 1), (ts(60), 2), (ts(61), 2)], key=repr)


def test_burst_bucket_split_matches_plain_window(spark):
    # many buckets: bucket size == window, so every row needs context rows
    data = [(u, ts(s)) for u in (1, 2) for s in range(0, 3600, 7)] + [(1, ts(100)), (1, ts(100))]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz")
    split = A.burst_events(df, "u", "t", window="1 minute", min_count=1, bucket="1 minute")
    df.createOrReplaceTempView("burst_in")
    plain = spark.sql("""SELECT u, t, COUNT(*) OVER (PARTITION BY u ORDER BY t
                         RANGE BETWEEN INTERVAL 1 MINUTE PRECEDING AND CURRENT ROW) AS events_in_window
                         FROM burst_in""")
    assert rows(split, "u", "t", "events_in_window") == rows(plain, "u", "t", "events_in_window")


def test_customer_tiers_ntile(spark):
    df = spark.createDataFrame([(i, float(100 - i)) for i in range(7)], "c long, amt double")
    out = A.customer_tiers(df, "c", "amt", num_partitions=3)
    seg = dict((r.c, r.customer_segment) for r in out.collect())
    assert [seg[i] for i in range(7)] == ["High Value"] * 3 + ["Medium Value"] * 2 + ["Low Value"] * 2
    two = A.customer_tiers(df.filter("c < 2"), "c", "amt")
    assert sorted(r.customer_segment for r in two.collect()) == ["High Value", "Medium Value"]


def test_first_purchase_tie_break_and_null_key(spark):
    df = spark.createDataFrame([(None, ts(5), 1), (None, ts(1), 2), (7, ts(3), 9), (7, ts(3), 4)],
                               "c long, t timestamp_ntz, id long")
    out = A.first_purchase(df, "c", "t", tie_break=["id"])
    assert rows(out, "c", "id") == sorted([(None, 2), (7, 4)], key=repr)


def test_outliers_single_row_user_dropped(spark):
    data = [(1, float(v)) for v in [10] * 20 + [1000]] + [(2, 5000.0)]
    df = spark.createDataFrame(data, "u long, v double")
    out = A.outliers_sigma(df, "u", "v")
    assert rows(out, "u", "v") == [(1, 1000.0)]


def test_funnel_empty_stage_gives_null_rate(spark):
    a = spark.createDataFrame([(1,), (2,)], "u long")
    empty = a.filter("u < 0")
    out = A.purchase_funnel([("visits", a, "u"), ("cart", empty, "u"), ("purchases", a, "u")]).first()
    assert (out.total_visits, out.total_cart, out.total_purchases) == (2, 0, 2)
    assert out.visits_to_cart_rate == 0.0 and out.cart_to_purchases_rate is None


def test_monthly_growth_zero_previous(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), 0.0), (dt.datetime(2024, 2, 5), 10.0)],
                               "t timestamp_ntz, a double")
    out = A.monthly_revenue_growth(df, "t", "a").orderBy("month").collect()
    assert out[0].previous_month is None and out[0].growth_percent is None
    assert out[1].previous_month == 0.0 and out[1].growth_percent is None


def test_activity_streak_with_repeated_day(spark):
    days = [dt.datetime(2024, 1, d, h) for d in range(1, 6) for h in ((0, 5) if d == 3 else (0,))]
    df = spark.createDataFrame([(1, d) for d in days], "u long, t timestamp_ntz")
    out = A.activity_streaks(df, "u", "t", min_len=5).collect()
    assert [(r.start_streak.day, r.end_streak.day, r.streak_length) for r in out] == [(1, 5, 5)]


def test_sessionize_boundary(spark):
    df = spark.createDataFrame([(1, ts(0)), (1, ts(1800)), (1, ts(3601))], "u long, t timestamp_ntz")
    out = A.sessionize(df, "u", "t", gap="30 minutes")
    assert [r.session_id for r in out.orderBy("t").collect()] == [1, 1, 2]


def test_churn_gap_telescopes(spark):
    d = [dt.datetime(2024, 1, x) for x in (1, 3, 4, 10)]
    df = spark.createDataFrame([(1, x) for x in d] + [(2, dt.datetime(2024, 1, 1))], "c long, t timestamp_ntz")
    out = A.churn_risk(df, "c", "t", "2024-02-01", factor=2.0).collect()
    assert len(out) == 1 and out[0].c == 1 and out[0].avg_gap == 3.0 and out[0].days_since_last_order == 22


def test_market_basket_counts_and_ties(spark):
    lines = [(1, 10), (1, 20), (1, 30), (2, 10), (2, 20), (3, 10), (3, 10), (3, 20)]
    df = spark.createDataFrame(lines, "o long, p long")
    out = A.market_basket_pairs(df, "o", "p", max_rank=1)
    # (10,20): orders 1, 2 and 3 (twice: repeated line multiplies) = 4
    assert rows(out, "product_a", "product_b", "pair_count", "rank") == [(10, 20, 4, 1)]
    all_pairs = A.market_basket_pairs(df, "o", "p", max_rank=10)
    assert rows(all_pairs, "product_a", "product_b", "pair_count") == [(10, 20, 4), (10, 30, 1), (20, 30, 1)]


def test_top_n_dense_rank_keeps_ties(spark):
    df = spark.createDataFrame([("r", "a", 5.0), ("r", "b", 5.0), ("r", "c", 4.0), ("r", "d", 3.0),
                                ("r", "e", 2.0)], "g string, s string, v double")
    out = A.top_n_dense_rank(df, "g", "v", n=3)
    assert rows(out, "s") == [("a",), ("b",), ("c",), ("d",)]


def test_time_between_purchases(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 11))],
                               "u long, d timestamp_ntz")
    out = A.time_between_purchases(df, "u", "d").orderBy("d").collect()
    assert out[0].days_between is None and out[1].days_between == 10


def test_market_basket_hot_basket_grid_split(spark):
    import random
    rnd = random.Random(3)
    lines = [(1, p) for p in range(60)] + [(o, rnd.randrange(60)) for o in range(2, 40) for _ in range(4)]
    df = spark.createDataFrame(lines, "o long, p long")
    split = A.market_basket_pairs(df, "o", "p", max_rank=5, block_size=7)
    plain = A.market_basket_pairs(df, "o", "p", max_rank=5, block_size=10**9)
    cols = ("product_a", "product_b", "pair_count", "rank")
    assert rows(split, *cols) == rows(plain, *cols)


def test_sessionize_ignores_session_time_zone_at_dst(spark):
    # NTZ wall clock 01:50 -> 03:10 across the US spring-forward: 80 minutes
    # of wall clock (a new session), whatever the session time zone says
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1, dt.datetime(2024, 3, 10, 1, 50)), (1, dt.datetime(2024, 3, 10, 3, 10))],
                                   "u long, t timestamp_ntz")
        got = [r.session_id for r in A.sessionize(df, "u", "t", gap="70 minutes").orderBy("t").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1, 2]


def test_burst_hot_user_split_matches_plain(spark):
    data = [(1, ts(s)) for s in range(0, 7200, 3)] + [(2, ts(s)) for s in range(0, 600, 60)] + [(None, ts(5))]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz")
    split = A.burst_events(df, "u", "t", window="1 minute", min_count=1, rows_per_segment=50)
    plain = A.burst_events(df, "u", "t", window="1 minute", min_count=1)
    assert rows(split, "u", "t", "events_in_window") == rows(plain, "u", "t", "events_in_window")


def test_basket_tasks_grow_with_lines_and_pairs(spark, monkeypatch):
    """No task has over about ``ROWS_PER_TASK`` lines or pairs to meet; the answer stays."""
    df = spark.range(4_000).select((F.col("id") % 500).alias("o"), (F.xxhash64("id") % 150).alias("p"))
    plain = [tuple(r) for r in A.market_basket_pairs(df, "o", "p", max_rank=10).collect()]
    monkeypatch.setattr(A, "ROWS_PER_TASK", 100, raising=False)
    for block in (2_000, 3):
        out = A.market_basket_pairs(df, "o", "p", max_rank=10, block_size=block)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan
        assert sorted(map(tuple, out.collect())) == sorted(plain)
