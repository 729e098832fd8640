import datetime as dt

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tablekit.operators import analytics as A
from tablekit.session import scratch_path
from tablekit.sources import files as FS
from tablekit.sources import ingest as IN
from tablekit.sources import jdbc as JD
from tablekit.sources import logs as LG
from tablekit.sources import tables as TB
from tablekit.streaming import sessions as SS


def test_read_table_partition_filter(spark):
    path = scratch_path(spark, "t_read")
    spark.createDataFrame([(1, "a"), (2, "b")], "v long, p string").write.partitionBy("p").parquet(path)
    assert TB.partition_columns(spark, path) == ["p"]
    out = TB.read_table(spark, path, {"p": "a", "v": 2}, where="v >= 1")
    assert rows(out, "v", "p") == [(1, "a")]


def test_jdbc_options_only():
    o = JD.jdbc_read_options("jdbc:x", table="t", where="a = 1", derive={"Year": "YEAR(d)"},
                             partition=("id", 0, 100, 4))
    assert o["dbtable"] == "(SELECT *, YEAR(d) AS Year FROM t WHERE a = 1) src"
    assert o["numPartitions"] == "4" and o["fetchsize"] == "10000"
    w = JD.jdbc_write_options("jdbc:x", "t")
    assert "partitionColumn" not in w and w["batchsize"] == "10000"


def test_ingest_modes(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "s"), (2, dt.datetime(2024, 1, 2), "s")],
                               "k long, t timestamp_ntz, secret string")
    target = scratch_path(spark, "t_ing")
    rep = IN.ingest_full(df.limit(1), target, drop_cols=["secret"]).first()
    assert rep.records == 1 and "secret" not in spark.read.parquet(target).columns
    assert IN.ingest_incremental(df.drop("secret"), target, "t").first().records == 1
    assert IN.ingest_compare(df.drop("secret"), target).first().status == "SKIPPED"
    upd = spark.createDataFrame([(2, dt.datetime(2024, 1, 5))], "k long, t timestamp_ntz")
    IN.ingest_merge(upd, target, "k", staging=scratch_path(spark, "t_stage"))
    assert rows(spark.read.parquet(target), "k", "t") == [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 5))]
    assert IN.target_name("Sales Orders", "ERP") == "erp_sales_orders"


def test_copy_and_convert(spark, tmp_path):
    src = scratch_path(spark, "t_copy_src")
    spark.createDataFrame([(1, "a"), (2, "b")], "v long, p string").write.partitionBy("p").parquet(src)
    dst = scratch_path(spark, "t_copy_dst")
    assert FS.copy_table_if_absent(spark, src, dst).first().status == "COPIED"
    assert FS.copy_table_if_absent(spark, src, dst).first().status == "EXISTS"
    csv = str(tmp_path / "c.csv")
    (tmp_path / "c.csv").write_bytes("nome,v\nJoão,1\n".encode("latin1"))
    out = FS.convert_format(spark, csv, str(tmp_path / "j"), "csv", "json", read_options={"encoding": "latin1"})
    assert out.first().nome == "João"


def test_compact_zorder(spark):
    small = scratch_path(spark, "t_small")
    spark.range(2000).select((F.col("id") % 37).alias("a"), (F.col("id") % 11).alias("b")) \
        .repartition(10).write.parquet(small)
    out = scratch_path(spark, "t_compact")
    m = {r.stage: r for r in FS.compact_table(spark, small, out, target_mb=64, cluster_by=["a", "b"],
                                              zorder=True).collect()}
    assert m["before"].num_files == 10 and m["after"].num_files == 1
    assert spark.read.parquet(out).count() == 2000


LOG = """orphan line
2024-01-01 00:00:00,001 INFO app.main started
2024-01-01 00:00:01,002 ERROR app.db failed to connect
Traceback (most recent call last):
ValueError: boom
2024-01-01 00:00:02,003 INFO short
"""


def test_parse_log(spark, tmp_path):
    p = tmp_path / "app.log"
    p.write_text(LOG)
    out = {r.Message: r for r in LG.parse_log(spark, str(p), run_id="r").collect()}
    assert out["orphan line"].Level is None
    err = out["failed to connect"]
    assert err.Level == "ERROR" and err.Exception_Message == "failed to connect"
    assert err.Stack_Trace == "Traceback (most recent call last):\nValueError: boom"
    assert out["2024-01-01 00:00:02,003 INFO short"].Level is None   # 4 parts: message only
    assert len(out) == 4


def test_stream_sessions_equal_batch_less_open(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = scratch_path(spark, "t_stream_src")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    sink, ck = scratch_path(spark, "t_sink"), scratch_path(spark, "t_ck")
    q = (SS.session_summary_stream(stream, "user_id", "ts", "30 minutes", "0 seconds").writeStream
         .format("parquet").option("path", sink).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = spark.read.parquet(sink).count()
    batch = A.sessionize(ev, "user_id", "ts", tie_break=["event_id"]) \
        .groupBy("user_id", "session_id").agg(F.max("ts").alias("last"))
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("last") + F.expr("INTERVAL 30 MINUTES") <= F.lit(max_ts)).count()
    assert streamed == closed and batch.count() - streamed >= 1


def test_parse_log_across_many_blocks(spark, tmp_path):
    # ~1 MB log read in 16 KB splits: entries cross block borders
    lines, expect = [], []
    for i in range(6000):
        level = "ERROR" if i % 7 == 0 else "INFO"
        lines.append(f"2024-01-01 00:{i // 600 % 60:02d}:{i % 60:02d},{i % 1000:03d} {level} app.x message {i}")
        trace = [f"  trace line {i}.{j}" for j in range(i % 4)] if level == "ERROR" else []
        lines.extend(trace)
        expect.append((f"message {i}", "\n".join(trace) if trace else None))
    (tmp_path / "big.log").write_text("orphan\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        raw = spark.read.text(str(tmp_path / "big.log"))
        assert raw.rdd.getNumPartitions() > 10
        got = LG.parse_log(spark, str(tmp_path / "big.log"), run_id="r").select("Message", "Stack_Trace").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted(((r.Message, r.Stack_Trace) for r in got), key=repr)
    assert got == sorted(expect + [("orphan", None)], key=repr)


def test_analyze_columns(spark):
    path = scratch_path(spark, "t_analyze")
    spark.range(100).withColumn("b", F.col("id") % 7).write.parquet(path)
    spark.sql(f"CREATE TABLE tk_analyze USING parquet LOCATION '{path}'")
    try:
        stats = TB.analyze_columns(spark, "tk_analyze", ["b"]).first().data_type
        assert "100 rows" in stats
        col = spark.sql("DESCRIBE TABLE EXTENDED tk_analyze b").collect()
        assert any(r.info_value == "7" for r in col if r.info_name == "distinct_count")
    finally:
        spark.sql("DROP TABLE IF EXISTS tk_analyze")


def test_stream_sessions_across_batches_and_late_data(spark):
    import time as _time
    t0 = dt.datetime(2024, 1, 1)
    schema = "user_id long, ts timestamp_ntz, event_id long"
    batches = [[(1, t0 + dt.timedelta(minutes=m), m) for m in ms] for ms in ([0, 10, 20], [35, 100], [200, 300])]
    late = [(1, t0 + dt.timedelta(minutes=5), 999)]            # older than the watermark by then
    src = scratch_path(spark, "t_stream_multi")
    sink, ck = scratch_path(spark, "t_sink_multi"), scratch_path(spark, "t_ck_multi")

    def start():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        return (SS.session_summary_stream(stream, "user_id", "ts", "30 minutes", "0 seconds").writeStream
                .format("parquet").option("path", sink).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    for b in batches:                       # files written in event-time order
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
        _time.sleep(1.1)
    start().awaitTermination()
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination()              # restart from the checkpoint: state and watermark kept
    got = sorted((r.session_start.minute + 60 * r.session_start.hour, r.event_count)
                 for r in spark.read.parquet(sink).collect())
    # sessions: [0,10,20,35] (4 events, 35 - 20 < 30), [100], [200]; [300] is still open
    assert got == [(0, 4), (100, 1), (200, 1)]


def test_stream_insert_only_across_batches(spark):
    import time as _time
    from tablekit.streaming import merge as SM
    schema = "event_id long, ts timestamp_ntz, v string"
    t0 = dt.datetime(2024, 1, 1)
    first = [(i, t0 + dt.timedelta(minutes=i), "a") for i in range(20)]
    second = [(i, t0 + dt.timedelta(minutes=i), "b") for i in range(10, 30)]   # 10..19 repeat
    src = scratch_path(spark, "t_ins_src")
    for rows_ in (first, second):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(src)
        _time.sleep(1.1)
    target, ck = scratch_path(spark, "t_ins_target"), scratch_path(spark, "t_ins_ck")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    SM.merge_insert_new_stream(stream, target, "event_id", "ts", checkpoint=ck).awaitTermination()
    got = {r.event_id: r.v for r in spark.read.parquet(target).collect()}
    assert sorted(got) == list(range(30))
    assert all(got[i] == "a" for i in range(20)) and all(got[i] == "b" for i in range(20, 30))


def test_streamed_sessions_of_a_hot_user_equal_batch_sessions(spark):
    """A user with a third of the stream, NULL users and times,
    gaps of exactly the session gap; no session setting."""
    import datetime as dt
    import random
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    data = [(1 if i % 3 == 0 else rnd.choice([None, *range(2, 30)]), t0 + dt.timedelta(seconds=rnd.randrange(30_000)), i) for i in range(6000)]
    data += [(50, t0 + dt.timedelta(minutes=30 * i), i) for i in range(6)] + [(51, t0 + dt.timedelta(minutes=30 * i, microseconds=i), i) for i in range(6)]
    data += [(7, None, 1), (None, t0 + dt.timedelta(days=2), 2)]
    schema = "user_id long, ts timestamp_ntz, event_id long"
    ev = spark.createDataFrame(data, schema)
    src, sink, ck = (scratch_path(spark, f"t_hot_{x}") for x in ("src", "sink", "ck"))
    ev.repartition(3).write.parquet(src)
    q = (SS.session_summary_stream(spark.readStream.schema(schema).parquet(src), "user_id", "ts", "1 minute", "0 seconds")
         .writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    batch = (A.sessionize(ev.filter("ts is not null"), "user_id", "ts", gap="1 minute", tie_break=["event_id"]).groupBy("user_id", "session_id")
             .agg(F.min("ts").alias("s"), (F.max("ts") + F.expr("INTERVAL 1 MINUTE")).alias("e"), F.count(F.lit(1)).alias("n"))
             .filter(F.col("e") <= F.lit(t0 + dt.timedelta(days=2))))
    assert rows(spark.read.parquet(sink), "user_id", "session_start", "session_end", "event_count") == rows(batch, "user_id", "s", "e", "n")
    parts = SS._combined(ev.filter("user_id = 1").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at")).coalesce(1), 60_000_000)
    assert parts.count() <= 502 and parts.agg(F.sum("n")).first()[0] == 2000   # 500 minutes


def test_zorder_keeps_texts_together(spark):
    """A prefix range meets few files after clustering, all after a plain rewrite."""
    df = spark.range(20_000).select(F.concat(F.lit("customer/"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("string"), 6, "0"),
                                             F.lit(" é")).alias("name"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("v"))
    plain, out = scratch_path(spark, "t_plain"), scratch_path(spark, "t_z")
    df.repartition(16).write.parquet(plain)
    FS.compact_table(spark, plain, out, target_mb=0.005, cluster_by=["name", "v"], zorder=True)

    def met(path):
        held = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("name").alias("a"), F.max("name").alias("b"))
        return held.count(), held.filter("b >= 'customer/0310' and a < 'customer/0311'").count()

    files, hit = met(out)
    assert met(plain) == (16, 16) and files >= 20 and hit <= files / 2
    assert rows(spark.read.parquet(out)) == rows(df)
    with_null = spark.createDataFrame([(None, 1), ("", 2), ("b", 3)], "t string, n int")
    assert with_null.select(FS.zorder_key(with_null, ["t"]).alias("z")).count() == 3
