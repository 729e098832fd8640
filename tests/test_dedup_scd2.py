import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tablekit.operators import dedup as D
from tablekit.operators import scd2 as S
from tablekit.plans.ranking import global_positions
from tablekit.session import scratch_path


def test_dedup_and_duplicates_partition_input(spark):
    data = [(1, 1, 5), (1, 1, 3), (1, 2, 1), (None, 1, 2), (None, 1, 1), (2, 3, 1)]
    df = spark.createDataFrame(data, "k long, o long, id long")
    firsts = D.dedup_keep_first(df, "k", ["o", "id"])
    dups = D.find_duplicates(df, "k", ["o", "id"])
    assert rows(firsts, "k", "o", "id") == sorted([(1, 1, 3), (None, 1, 1), (2, 3, 1)], key=repr)
    assert firsts.count() + dups.count() == df.count()


def test_merge_insert_new_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (1, "a2")], "k long, v string")
    staging = spark.createDataFrame([(1, "x"), (2, "b"), (2, "c"), (None, "n")], "k long, v string")
    once = D.merge_insert_new(target, staging, "k", ["v"])
    twice = D.merge_insert_new(once, staging, "k", ["v"])
    assert rows(once) == sorted([(1, "a"), (1, "a2"), (2, "b"), (None, "n")], key=repr)
    # NULL keys never match, so only non-NULL keys are idempotent
    assert twice.filter("k is not null").count() == once.filter("k is not null").count()


def test_dedup_partition_leaves_other_partitions(spark):
    path = scratch_path(spark, "t_dedup_part")
    df = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "b", 1), (2, 1, "c", 2), (2, 1, "d", 2)],
                               "k long, o long, v string, p int")
    df.write.partitionBy("p").parquet(path)
    import hashlib
    import os
    from tablekit.session import local_path

    def other_files():
        root = os.path.join(local_path(path), "p=2")
        return {f: hashlib.sha256(open(os.path.join(root, f), "rb").read()).hexdigest()
                for f in os.listdir(root)}

    before = other_files()
    D.dedup_partition(spark, path, "p", 1, "k", ["o"], staging_path=scratch_path(spark, "t_stage"))
    back = spark.read.parquet(path)
    assert rows(back, "k", "v", "p") == [(1, "a", 1), (2, "c", 2), (2, "d", 2)]
    assert other_files() == before          # other partitions untouched, byte for byte


def test_scd2_intervals_open_end(spark):
    df = spark.createDataFrame([(1, "BR", dt.datetime(2024, 1, 1)), (1, "PT", dt.datetime(2024, 2, 1))],
                               "u long, c string, t timestamp_ntz")
    out = S.scd2_intervals(df, "u", "c", "t").orderBy("valid_from").collect()
    assert out[0].valid_to == dt.datetime(2024, 2, 1) and out[1].valid_to == dt.datetime(9999, 12, 31)
    same = spark.createDataFrame([(1, "BR", dt.datetime(2024, 1, 1)), (1, "BR", dt.datetime(2024, 2, 1))],
                                 "u long, c string, t timestamp_ntz")
    assert S.scd2_intervals(same, "u", "c", "t").count() == 2
    assert S.scd2_intervals(same, "u", "c", "t", collapse=True).count() == 1


def test_scd2_overlaps_modes(spark):
    df = spark.createDataFrame([(1, 1, 100), (1, 2, 3), (1, 4, 5), (2, 1, None), (2, 5, 9), (3, 1, 3), (3, 3, 5)],
                               "k long, s long, e long")
    adj = S.scd2_overlaps(df, "k", "s", "e", mode="adjacent")
    anyo = S.scd2_overlaps(df, "k", "s", "e", mode="any")
    assert rows(adj, "k", "s") == [(1, 2), (2, 5)]
    assert rows(anyo, "k", "s") == [(1, 2), (1, 4), (2, 5)]


def test_scd2_single_current(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, True), (3, True), (4, None)], "k long, f boolean")
    out = S.scd2_single_current(df, "k", "f")
    assert rows(out, "k", "current_count") == [(1, 0), (3, 2), (4, 0)]


DIM = "SurrogateKey long, k long, a string, Start_Date timestamp_ntz, End_Date timestamp_ntz, Flg_Is_Current boolean"


def _dim(spark, data):
    return spark.createDataFrame(data, DIM)


def test_scd2_merge_cases_and_invariants(spark):
    t0, now = dt.datetime(2020, 1, 1), "2024-01-01 00:00:00"
    cur = _dim(spark, [(1, 1, "x", t0, None, True), (2, 2, None, t0, None, True), (3, 3, "z", t0, None, True),
                       (4, 3, "old", dt.datetime(2019, 1, 1), t0, False)])
    new = spark.createDataFrame([(1, "x2"), (2, None), (3, "z"), (5, "n"), (5, "n")], "k long, a string")
    out = S.scd2_merge(new, cur, "k", ["a"], now=F.lit(now).cast("timestamp_ntz"))
    got = rows(out, "SurrogateKey", "k", "a", "Flg_Is_Current")
    assert (1, 1, "x", False) in got            # CHANGED expired
    assert (2, 2, None, True) in got            # NULL -> NULL unchanged
    assert (4, 3, "old", False) in got          # history passes through
    fresh = sorted(r for r in got if r[0] > 4)
    assert fresh == [(5, 1, "x2", True), (6, 5, "n", True)]  # keys continue max+1 in key order
    assert S.scd2_single_current(out, "k", "Flg_Is_Current").count() == 0
    assert S.scd2_overlaps(out, "k", "Start_Date", "End_Date").count() == 0


def test_scd2_merge_only_new_and_all_changed(spark):
    t0 = dt.datetime(2020, 1, 1)
    cur = _dim(spark, [(1, 1, "a", t0, None, True)])
    only_new = S.scd2_merge(spark.createDataFrame([(2, "b")], "k long, a string"), cur, "k", ["a"],
                            now=F.lit("2024-01-01").cast("timestamp_ntz"))
    assert only_new.count() == 2
    all_changed = S.scd2_merge(spark.createDataFrame([(1, "b")], "k long, a string"), cur, "k", ["a"],
                               now=F.lit("2024-01-01").cast("timestamp_ntz"))
    assert all_changed.count() == 2 and all_changed.filter("Flg_Is_Current").count() == 1


def test_global_positions_edge_cases(spark):
    empty = spark.createDataFrame([], "v long")
    assert global_positions(empty, [F.col("v")]).count() == 0
    same = spark.createDataFrame([(1, i) for i in range(50)], "v long, id long")
    pos = [r.position for r in global_positions(same, [F.col("v"), F.col("id")], num_partitions=5).collect()]
    assert sorted(pos) == list(range(1, 51))
