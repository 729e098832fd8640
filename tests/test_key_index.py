"""The key index of A23: files read, and no key lost or doubled."""

import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from tablekit.session import scratch_path
from tablekit.sources import key_index as KI
from tablekit.sources.files import remove_path
from tablekit.streaming import merge as SM

T0 = dt.datetime(2024, 1, 1)


def run(spark, batches, schema, keys, target, **how):
    src, ck, seen = scratch_path(spark, "t_ki_src"), scratch_path(spark, "t_ki_ck"), []
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        SM.merge_insert_new_stream(spark.readStream.schema(schema).parquet(src), target, keys, "ts",
                                   checkpoint=ck, on_batch=seen.append, **how).awaitTermination()
    return seen


def test_random_keys_read_few_files_and_lose_none(spark):
    rnd = random.Random(4)
    ids = rnd.sample(range(10**9), 4000)
    batch = lambda ks, v: [(k, T0, v) for k in ks]
    batches = [batch(ids[:2000], "a"), batch(ids[2000:3900], "b"),
               batch([*ids[3900:], *rnd.sample(ids[:3900], 3)], "c"),      # new keys and three old ones
               batch(ids[:50], "again")]
    target = scratch_path(spark, "t_ki_target")
    seen = run(spark, batches, "id long, ts timestamp_ntz, v string", "id", target, rows_per_file=100)
    got = {r.id: r.v for r in spark.read.parquet(target).collect()}
    want = {**dict.fromkeys(ids[:2000], "a"), **dict.fromkeys(ids[2000:3900], "b"), **dict.fromkeys(ids[3900:], "c")}
    assert got == want and spark.read.parquet(target).count() == 4000
    assert [s["keys"] for s in seen] == [2000, 1900, 103, 50]
    assert seen[0]["files"] == 0 and seen[2]["files"] >= 35
    assert seen[1]["files_read"] <= 10           # new keys: only false hits
    assert 1 <= seen[2]["files_read"] <= 8       # three old keys, 100 new ones
    assert seen[3]["files_read"] < seen[3]["files"]
    # the last batch brought nothing new: its file without rows is indexed like the others
    index = KI.KeyIndex(spark, target, ["id"], spark.read.parquet(target).schema)
    assert index.listed() == {f for files in index.indexed(index.generations(), index.listed()).values() for f in files}


def test_null_and_text_keys_of_two_columns(spark):
    schema = "a string, b double, ts timestamp_ntz, v int"
    one = [("x", 1.0, T0, 1), (None, 1.0, T0, 1), ("x", None, T0, 1), (None, None, T0, 1), ("", 0.0, T0, 1), ("n", float("nan"), T0, 1)]
    two = [(a, -0.0 if b == 0 else b, ts, 2) for a, b, ts, _ in one] + [("é", 1.0, T0, 2), ("\0", 1.0, T0, 2)]
    target = scratch_path(spark, "t_ki_nulls")
    seen = run(spark, [one, two, two], schema, ["a", "b"], target, rows_per_file=1)
    got = spark.read.parquet(target)
    assert got.count() == 8 and got.filter("v = 1").count() == 6
    held = got.select("_metadata.file_path").distinct().count()
    assert [s["keys"] for s in seen] == [6, 8, 8] and seen[2]["files_read"] == held   # all keys are there; files without rows are not read


def test_files_without_index_and_lost_index_are_read(spark):
    schema = "id long, ts timestamp_ntz, v string"
    target = scratch_path(spark, "t_ki foreign %41")
    spark.createDataFrame([(i, T0, "old") for i in range(50)], schema).repartition(3).write.parquet(target)
    seen = run(spark, [[(i, T0, "new") for i in range(40, 60)]], schema, "id", target)
    assert seen[0]["files"] == seen[0]["files_read"] == 3
    # another writer appends, then the index is lost
    spark.createDataFrame([(70, T0, "other")], schema).coalesce(1).write.mode("append").parquet(target)
    seen = run(spark, [[(70, T0, "new"), (71, T0, "new"), (1, T0, "new")]], schema, "id", target)
    assert seen[0]["files_read"] < seen[0]["files"]
    remove_path(spark, f"{target}/_key_index")
    run(spark, [[(71, T0, "newer"), (72, T0, "newer")]], schema, "id", target)
    got = spark.read.parquet(target)
    assert got.count() == got.select("id").distinct().count() == 63
    assert rows(got.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v", "n") == [("new", 11), ("newer", 1), ("old", 50), ("other", 1)]


def test_generations_stay_few_and_half_written_ones_do_not_count(spark):
    target = scratch_path(spark, "t_ki_gens")
    df = lambda lo, hi: spark.range(lo, hi).select("id")
    index = KI.KeyIndex(spark, target, ["id"], df(0, 1).schema, max_generations=3)
    for i in range(7):
        KI.spread_by_key(df(100 * i, 100 * i + 100), ["id"], 100, 50).write.mode("append").parquet(target)
        index.refresh()
        assert len(index.generations()) <= 3
    total = len(index.listed())
    for lo in range(0, 700, 100):
        files, n = index.may_hold(df(lo, lo + 100))
        held = {r[0] for r in index.read(f for f, _, _ in index.listed())
                .filter(F.col("id").between(lo, lo + 99)).select("_metadata.file_path").distinct().collect()}
        assert n == total and held <= set(files) and len(files) <= 4
    assert index.may_hold(df(10_000, 10_100))[0] == []
    remove_path(spark, f"{index.root}/{index.generations()[0]}/slots/_SUCCESS")
    files, _ = index.may_hold(df(10_000, 10_100))
    assert files                                  # unindexed again: read
    index.refresh()
    assert index.may_hold(df(10_000, 10_100))[0] == []
