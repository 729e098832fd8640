"""Partition values that are no plain words survive every rewrite (A14, I07,
I08, I11); CSV targets keep every row (I10); damaged dimensions (T02); edges
without a weight (G02); a caller's log parser and the audit append (I09)."""

import datetime as dt
import os

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablekit.operators import dedup as D
from tablekit.operators import graph as G
from tablekit.operators import scd2 as S
from tablekit.session import local_path, scratch_path
from tablekit.sources import files as FS
from tablekit.sources import ingest as IN
from tablekit.sources import logs as LG
from tablekit.sources import tables as TB

VALUES = ["01", "1", "02", "a:b", "x/y", "a=b", "b c", "2024-01-02", "1.0", "True", "%41", "é", None]


def folders(path):
    return sorted(f for f in os.listdir(local_path(path)) if "=" in f)


def write(spark, data, path):
    spark.createDataFrame(data, "k long, v string, p string").write.partitionBy("p").parquet(path)


def test_dedup_of_01_leaves_no_1(spark):
    path = scratch_path(spark, "t_pv")
    write(spark, [(1, "a", "01"), (1, "a", "01"), (2, "b", "02")], path)
    D.dedup_partition(spark, path, "p", "01", "k", ["v"], staging_path=scratch_path(spark, "t_st"))
    assert folders(path) == ["p=01", "p=02"]
    assert rows(TB.read_layout(spark, path)) == [(1, "a", "01"), (2, "b", "02")]


@pytest.mark.parametrize("value", VALUES)
def test_dedup_of_any_partition(spark, value):
    path = scratch_path(spark, "t_pv")
    data = [(k, "a", x) for x in VALUES for k in (1, 1, 2)]
    write(spark, data, path)
    before = folders(path)
    D.dedup_partition(spark, path, "p", value, "k", ["v"], staging_path=scratch_path(spark, "t_st"))
    data.remove((1, "a", value))
    assert folders(path) == before and rows(TB.read_layout(spark, path)) == sorted(data, key=repr)


def test_merge_moves_keys_between_odd_partitions(spark):
    for a, b in (("01", "02"), ("a:b", "x/y"), ("x/y", "z"), ("a=b", "b c"), (None, "01"), ("01", None)):
        path = scratch_path(spark, "t_pv")
        write(spark, [(0, "old", a), (1, "old", b)], path)
        new = spark.createDataFrame([(0, "new", b)], "k long, v string, p string")
        IN.ingest_merge(new, path, "k", staging=scratch_path(spark, "t_st"), partition_by=["p"])
        assert rows(TB.read_layout(spark, path)) == sorted([(0, "new", b), (1, "old", b)], key=repr), (a, b)
        assert len(folders(path)) == 1


def test_merge_with_declared_numbers_and_dates(spark):
    day = dt.date(2024, 1, 2)
    path = scratch_path(spark, "t_pv")
    df = spark.createDataFrame([(0, day, 7), (1, day, 8)], "k long, d date, n int")
    df.write.partitionBy("d", "n").parquet(path)
    IN.ingest_merge(spark.createDataFrame([(1, day, 7)], "k long, d date, n int"), path, "k",
                    staging=scratch_path(spark, "t_st"), partition_by=["d", "n"])
    assert rows(spark.read.parquet(path)) == [(0, day, 7), (1, day, 7)]


def test_incremental_append_tells_01_from_1(spark):
    path = scratch_path(spark, "t_pv")
    t = dt.datetime(2024, 1, 1)
    schema = "k long, at timestamp_ntz, p string"
    IN.ingest_full(spark.createDataFrame([(0, t, "01")], schema), path, partition_by=["p"])
    IN.ingest_incremental(spark.createDataFrame([(0, t, "01"), (0, t, "1")], schema), path, "at", partition_by=["p"])
    assert rows(TB.read_layout(spark, path)) == [(0, t, "01"), (0, t, "1")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(VALUES)), min_size=1, max_size=12), st.sampled_from(VALUES[:-1]))
def test_copy_and_compaction_keep_rows_and_folders(spark, data, value):
    src, dst = scratch_path(spark, "t_pv"), scratch_path(spark, "t_copy")
    write(spark, [(k, "x", p) for k, p in data], src)
    FS.copy_table_if_absent(spark, src, dst)
    FS.compact_table(spark, dst, scratch_path(spark, "t_out"), where=f"p = '{value}'")
    whole = scratch_path(spark, "t_whole")
    FS.compact_table(spark, dst, whole)
    for path in (dst, whole):
        assert folders(path) == folders(src)
        assert rows(TB.read_layout(spark, path)) == sorted([(k, "x", p) for k, p in data], key=repr)


def test_csv_targets_keep_every_row_and_text(spark):
    texts = ["a\nb", "", None, " lead", "trail ", 'say "so"', "back\\slash", 'q\\"', "c,d", "x\r\ny", "\t", "'", '"', "é", "1", "null", "#x", "\n"]
    src = scratch_path(spark, "t_src")
    spark.createDataFrame([(i, x, x) for i, x in enumerate(texts)], "k long, t string, u string").write.parquet(src)
    back = FS.convert_format(spark, src, scratch_path(spark, "t_csv"), "parquet", "csv")
    assert rows(back) == sorted([(i, x, x) for i, x in enumerate(texts)], key=repr)


def test_two_current_rows_become_one_new_version(spark):
    t0 = dt.datetime(2020, 1, 1)
    dim = spark.createDataFrame([(1, 10, "a", t0, None, True), (2, 10, "b", t0, None, True), (3, 11, "c", t0, None, True)],
                                "SurrogateKey long, id long, v string, Start_Date timestamp_ntz, End_Date timestamp_ntz, Flg_Is_Current boolean")
    for value in ("z", "b"):   # differs from both, or from one
        out = S.scd2_merge(spark.createDataFrame([(10, value), (11, "c")], "id long, v string"), dim, "id", now="2024-01-01 00:00:00")
        now = [r for r in out.collect() if r.Flg_Is_Current]
        assert sorted((r.SurrogateKey, r.id, r.v) for r in now) == [(3, 11, "c"), (4, 10, value)]
        assert out.count() == 4 and out.filter("End_Date is not null").count() == 2


def test_edges_without_a_weight_are_none(spark):
    e = spark.createDataFrame([(0, 1, None), (1, 2, None), (2, 1, None), (0, 3, 1.0)], "s long, d long, w double")
    assert rows(G.shortest_paths(e, "s", "d", "w", 0), "vertex", "distance", "negative_cycle") == sorted(
        [(0, 0.0, False), (1, None, False), (2, None, False), (3, 1.0, False)], key=repr)


def test_audit_append_is_keyed_by_run(spark):
    path, target = scratch_path(spark, "t_log"), scratch_path(spark, "t_audit")
    spark.createDataFrame([("2024-01-01 00:00:00,000 INFO a one",), ("2024-01-01 00:00:01,000 ERROR b two",), ("trace",)],
                          "value string").coalesce(1).write.text(path)

    def parser(lines):
        bad = F.element_at(lines, 1).contains("ERROR")
        return {"Message": F.array_join(lines, "|"), "parse_error": F.when(bad, "no errors here")}

    reports = [tuple(LG.persist_log(spark, path, target, run, parser=parser).first()) for run in ("r/1", "r:2", "r/1")]
    assert reports == [("r/1", "OK", 2), ("r:2", "OK", 2), ("r/1", "EXISTS", 0)]
    assert rows(LG.read_audit(spark, target), "Run_ID", "Level", "Message", "Raw_Line") == sorted(
        ((run, *x) for run in ("r/1", "r:2") for x in (
            (None, "2024-01-01 00:00:00,000 INFO a one", "2024-01-01 00:00:00,000 INFO a one"),
            ("PARSE_ERROR", "PARSE_FAIL: no errors here", "2024-01-01 00:00:01,000 ERROR b two\ntrace"))), key=repr)
    empty = scratch_path(spark, "t_log")
    spark.createDataFrame([], "value string").write.text(empty)
    assert LG.persist_log(spark, empty, target, "r3").first().status == "NO_DATA"
    assert LG.read_audit(spark, target).count() == 4
    with pytest.raises(ValueError):
        LG.parse_entries(spark.createDataFrame([("f", "1", ["x"])], "file string, entry_key string, lines array<string>"),
                         lambda lines: {"Nonsense": F.lit(1)})
