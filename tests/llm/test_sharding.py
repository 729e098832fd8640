"""Sharding by sampled splitters: the law of bytes, whole shards, hot keys."""

import random

import numpy as np
import pytest
from llm_corpus import prose  # noqa: F401
from pyspark.sql import functions as F

from tablekit.llm import sharding as S


def check(frame, out, shards, fine=S.FINE):
    rows = out.collect()
    assert len(rows) == frame.count()
    total = [0] * shards
    slots: list[list[int]] = [[] for _ in range(shards)]
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode()) + 8
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for s in slots:
        assert sorted(s) == list(range(len(s)))
    mean = sum(total) / shards
    largest = max((r["size"] for r in rows), default=0)
    assert max(total) - min(total) <= max(2 * mean / fine + 2, 2 * largest)
    if largest <= mean:
        assert max(total) - min(total) <= 4 * mean / fine + 16
    return rows, total


@pytest.fixture(scope="module")
def frame(spark, prose):
    rnd = random.Random(3)
    rows = [(i, prose(i, rnd.randint(0, 120))) for i in range(900)]
    rows += [(2000 + i, "a copy that a third of all rows share") for i in range(700)]    # a hot text
    rows += [(5, "one row, many times")] * 500                                            # identical rows
    rows += [(None, "no id")] * 3 + [(3000 + i, None) for i in range(5)] + [(4000, ""), (4001, prose(9, 5000))]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, Shard string, slot int").repartition(5)


def test_shards_hold_equal_bytes_and_stretches_of_the_order(spark, frame):
    out = S.shard_documents(frame, shards=6, range_rows=50)
    assert out.columns == ["doc_id", "text", "size", "shard", "slot"]
    rows, total = check(frame, out, 6)
    small = out.where(F.col("size") * (S.FINE * 6) <= sum(total)).withColumn("h", F.xxhash64("text"))
    ends = small.groupBy("shard").agg(F.min("h").alias("a"), F.max("h").alias("b")).orderBy("shard").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(ends, ends[1:]))  # ranges of the key
    inner = small.orderBy("shard", "slot").select("h").toPandas()["h"].to_numpy()
    assert (np.diff(inner) >= 0).all()


def test_overfull_ranges_are_subdivided(spark, frame):
    keyed = frame.select(F.xxhash64("text").alias("h"), F.xxhash64("doc_id").alias("k"), F.monotonically_increasing_id().alias("m"),
                         (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size")).cache()
    n, b = keyed.agg(F.count(F.lit(1)), F.sum("size")).first()
    _, held = S._split(keyed, ["h", "k", "m"], "size", n, b, 40)
    assert sum(x for x, _ in held.values()) == n and sum(x for _, x in held.values()) == b
    for rows, size in held.values():
        assert rows == 1 or (rows <= max(1, 2 * n / 40) and size <= 2 * b / 40)


def test_few_rows_one_row_and_none(spark):
    schema = "doc_id long, text string"
    for rows in ([], [(1, "abc")], [(None, None)], [(1, "a" * 1000), (2, "b"), (3, None)], [(1, "same")] * 7):
        frame = spark.createDataFrame(rows, schema)
        check(frame, S.shard_documents(frame, shards=4), 4)
    named = spark.createDataFrame([("x", "abc"), ("y", None)], "id string, body string")
    assert S.shard_documents(named, shards=2, doc_id="id", text="body").count() == 2
    with pytest.raises(ValueError):
        S.shard_documents(spark.createDataFrame([(1, "a")], "slot long, text string"), doc_id="slot")


def test_binary_search_equals_sorting():
    rnd = random.Random(1)
    keys = [tuple(rnd.randint(-3, 3) for _ in range(3)) for _ in range(400)]
    splitters = sorted(set(rnd.sample(keys, 40)))
    found = S.ranges_of(splitters, [np.array([k[i] for k in keys]) for i in range(3)])
    assert found.tolist() == [sum(s <= k for s in splitters) for k in keys]
    assert S.ranges_of([], [np.array([1]), np.array([2]), np.array([3])]).tolist() == [0]


def test_large_records_and_levels():
    shard, loads = S.deal_large([9, 5, 4, 4, 1], 3)
    assert shard == [0, 1, 2, 2, 1] and loads == [9, 6, 8]
    assert S.fill_levels([9, 6, 8], 4) == [0, 6, 8]        # up to level 9
    assert S.fill_levels([0, 0], 5)[-1] == 10
    assert S.fill_levels([7, 0, 0], 0) == [0, 0, 0]


def test_written_shards_hold_the_texts(spark, frame, tmp_path):
    out = S.shard_documents(frame, shards=3)
    S.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, frame.select("doc_id", "text").collect()))
    assert back.select("shard").distinct().count() == 3
