"""Cases outside the fixtures: exact copies, tie floods, NULL ties, repeated
keys, half-written targets, late rows, scratch folders."""

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablekit import session as SE
from tablekit.operators import analytics as A
from tablekit.operators import dedup as D
from tablekit.operators import quality as Q
from tablekit.operators import scd2 as S
from tablekit.session import scratch_path
from tablekit.sources import files as FS
from tablekit.sources import ingest as IN
from tablekit.streaming import merge as SM


def test_find_duplicates_keeps_exact_copies(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (1, 10), (2, 5), (None, 1), (None, 1), (3, 2), (3, 1)], "k long, v long")
    assert rows(D.find_duplicates(df, "k", "v")) == sorted([(1, 10), (1, 10), (None, 1), (3, 2)], key=repr)
    assert D.dedup_keep_first(df, "k", "v").count() + 4 == df.count()


def test_ranks_when_everything_ties(spark):
    df = spark.createDataFrame([("a", i, 7.0) for i in range(200)] + [("a", 999, 1.0), ("b", 1, None), ("b", 2, 3.0)],
                               "g string, i long, m double")
    got = rows(A.top_n_dense_rank(df, "g", "m", n=1), "g", "i", "rank")
    assert got == sorted([("a", i, 1) for i in range(200)] + [("b", 2, 1)], key=repr)
    assert ("a", 999, 2) in rows(A.top_n_dense_rank(df, "g", "m", n=2), "g", "i", "rank")
    ranked = A.ranked_values(df, ["g"], "m", 3, "rank", dense=False)
    assert rows(ranked.filter("g = 'a'"), "rank") == [(1,)] * 200       # rank 201 is out
    assert rows(ranked.filter("g = 'b'"), "i", "rank") == [(1, 2), (2, 1)]


def test_basket_pairs_all_tied_without_a_global_window_over_pairs(spark):
    df = spark.createDataFrame([(o, p) for o in range(3) for p in range(20)], "o long, p long")
    out = A.market_basket_pairs(df, "o", "p", max_rank=10)
    assert out.count() == 190 and rows(out.select("rank").distinct()) == [(1,)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("\n"):
        if "Window [" in line:
            assert "product_a" not in line


def test_segments_order_nulls_as_windows_do(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    data = [(1, day(d), p, t) for d, p, t in ((1, "x", 1), (1, "y", None), (1, "x", 2), (2, "x", None), (2, "z", 1), (3, "z", 4), (3, "x", None))]
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, p string, tie long")
    for collapse in (False, True):
        want = S.scd2_intervals(df, "k", "p", "ts", tie_break=["tie"], collapse=collapse)
        got = S.scd2_intervals(df, "k", "p", "ts", tie_break=["tie"], collapse=collapse, rows_per_segment=2)
        assert rows(got) == rows(want)


def test_incremental_keeps_ties_and_nulls_at_the_mark(spark):
    schema = "k long, w long"
    target = scratch_path(spark, "t_inc")
    IN.ingest_full(spark.createDataFrame([(1, 5)], schema), target)
    src = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 6), (5, 4)], schema)
    assert IN.ingest_incremental(src, target, "w").first().records == 3
    assert IN.ingest_incremental(src, target, "w").first().records == 0
    assert rows(spark.read.parquet(target)) == sorted([(1, 5), (2, 5), (3, None), (4, 6)], key=repr)


def test_merge_rewrites_touched_partitions_only(spark):
    schema = "k long, p string, v string"
    target = scratch_path(spark, "t_merge")
    IN.ingest_full(spark.createDataFrame([(1, "a", "o"), (2, "b", "o"), (3, "c", "o"), (None, "c", "o")], schema), target, partition_by=["p"])
    before = {f: os.path.getmtime(f) for f in spark.read.parquet(target + "/p=c").inputFiles() for f in [f.replace("file://", "").replace("file:", "")]}
    new = spark.createDataFrame([(1, "a", "n2"), (1, "a", "n1"), (2, "a", "n"), (9, "d", "n")], schema)
    IN.ingest_merge(new, target, "k", scratch_path(spark, "t_merge_stage"), partition_by=["p"], tie_break="v")
    assert rows(spark.read.parquet(target), "k", "p", "v") == sorted(
        [(1, "a", "n1"), (2, "a", "n"), (3, "c", "o"), (None, "c", "o"), (9, "d", "n")], key=repr)
    assert all(os.path.getmtime(f) == m for f, m in before.items()) and before


def test_copy_replaces_a_half_written_target(spark):
    src, dst = scratch_path(spark, "t_src"), scratch_path(spark, "t_half")
    spark.createDataFrame([(1, "a"), (2, "b")], "v long, p string").write.partitionBy("p").parquet(src)
    spark.range(3).write.parquet(dst + "/_temporary")
    assert FS.copy_table_if_absent(spark, src, dst).first().status == "REPLACED"
    assert rows(spark.read.parquet(dst), "v", "p") == [(1, "a"), (2, "b")]
    assert FS.layout_columns(spark, dst) == ["p"]
    assert FS.copy_table_if_absent(spark, src, dst).first().status == "EXISTS"


def test_compaction_keeps_the_partition_layout(spark):
    path = scratch_path(spark, "t_parts")
    spark.range(100).select("id", (F.col("id") % 2).alias("m")).repartition(4).write.partitionBy("m").parquet(path)
    out = scratch_path(spark, "t_parts_out")
    FS.compact_table(spark, path, out, target_mb=64)
    assert FS.layout_columns(spark, out) == ["m"] and spark.read.parquet(out).count() == 100
    report = {r.stage: r.num_files for r in FS.compact_table(spark, path, scratch_path(spark, "t_one"), where="m = 1").collect()}
    assert report["after"] < report["before"]
    assert spark.read.parquet(path).count() == 100
    by = {r.m: r.num_files for r in Q.small_file_report(spark, path, by="m").collect()}
    assert by["1"] == 1 and by["0"] == 4


def test_file_report_counts_empty_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).coalesce(1).write.parquet(path)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    r = Q.small_file_report(spark, path).first()
    assert (r.num_files, r.total_bytes) == (len(files), sum(os.path.getsize(f"{path}/{f}") for f in files))


def test_stream_merge_inserts_late_keys_and_null_keys_once(spark):
    schema = "k long, ts timestamp_ntz, v string"
    t0 = dt.datetime(2024, 1, 10)
    src, target, ck = (scratch_path(spark, f"t_late_{x}") for x in ("src", "target", "ck"))

    def run(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        SM.merge_insert_new_stream(spark.readStream.schema(schema).parquet(src), target, "k", "ts", checkpoint=ck).awaitTermination()

    run([(1, t0, "b"), (1, t0 - dt.timedelta(hours=1), "a"), (None, t0, "n")])
    run([(1, t0 - dt.timedelta(days=2), "z"), (3, t0 - dt.timedelta(days=9), "late"), (None, t0, "again")])
    assert rows(spark.read.parquet(target), "k", "v") == sorted([(1, "a"), (3, "late"), (None, "n")], key=repr)


def test_scratch_is_released(spark):
    path = scratch_path(spark, "t_scratch")
    kept = SE.materialize(spark.range(5), "t_kept")
    spark.range(3).write.parquet(path)
    assert FS.path_exists(spark, path) and kept.count() == 5
    SE.discard(kept)
    assert not FS.path_exists(spark, kept._tk_path)
    SE.release_scratch(spark)
    assert not FS.path_exists(spark, path)


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master, applicationId = "spark://somewhere:7077", "app"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SE.checkpoint_root(Session())
