import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.hashing import joined_text
from tablekit.operators import quality as Q
from tablekit.operators import transform as TR


def test_null_ratio_statuses(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a long, b string")
    m = {r.column_name: r for r in Q.null_ratio_check(df, {"a": 0.0, "b": 0.4, "zz": 0.1}).collect()}
    assert m["a"].status == "OK" and m["b"].status == "FAIL" and m["b"].null_ratio == 0.5
    assert m["zz"].status == "MISSING_COLUMN" and m["zz"].null_ratio is None
    assert Q.null_ratio_ok(Q.null_ratio_check(df, {"a": 0.0, "zz": 0.1})).first().ok is False
    empty = Q.null_ratio_check(df.filter("a < 0"), {"a": 0.0}).first()
    assert empty.status == "EMPTY_DF" and empty.null_ratio is None


def test_number_range_inclusive_nulls_ok(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,), (11.0,), (-1.0,)], "v double")
    r = Q.number_range_check(df, "v", 0, 10).first()
    assert (r.below_count, r.above_count, r.actual_min, r.actual_max, r.status) == (1, 1, -1.0, 11.0, "FAIL")
    assert Q.number_range_violations(df, "v", 0, 10).count() == 2


def test_date_range_string_and_invalid(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-12-31",), ("bad",), (None,), ("2025-01-01",)], "d string")
    r = Q.date_range_check(df, "d", "2024-01-01", "2024-12-31").first()
    assert (r.below_count, r.above_count, r.invalid_count) == (0, 1, 2)


def test_partition_skew_ratio(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [(None,)] * 1, "k string")
    r = Q.partition_skew(df, "k", threshold=1.5).first()
    assert (r.distinct_keys, r.max_count, r.avg_count) == (3, 6, 3.0) and r.is_skewed
    top = Q.partition_skew_keys(df, "k", top=1).first()
    assert top.k == "a" and abs(top.share - 6 / 9) < 1e-12


def test_duplicate_and_referential(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k long")
    r = Q.duplicate_check(df, "k").first()
    assert (r.duplicated_keys, r.surplus_rows, r.total_rows) == (2, 3, 6)
    parent = spark.createDataFrame([(1,)], "k long")
    assert rows(Q.referential_integrity(df, parent, "k"), "k") == sorted([(2,), (None,), (None,)], key=repr)


def test_row_count_and_schema(spark):
    a = spark.range(5)
    r = Q.row_count_compare(a, a.limit(3)).first()
    assert (r.source_count, r.target_count, r.counts_equal) == (5, 3, False)
    df = spark.createDataFrame([("1", "x"), ("y", "z")], "a string, b string")
    exp = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("c", T.StringType())])
    m = {r.column_name: r for r in Q.schema_check(df, exp).collect()}
    assert m["a"].status == "TYPE_MISMATCH" and m["a"].uncastable_rows == 1
    assert m["c"].status == "MISSING" and m["b"].status == "EXTRA"


def test_table_freshness_from_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    r = Q.table_freshness(spark.read.parquet(str(tmp_path / "t")), as_of=str(dt.date.today())).first()
    assert r.age_days in (0, 1) and r.last_modified is not None


def test_hash_modes(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    compat = [r.h for r in df.select(F.sha2(joined_text(["x", "y", "z"], "compat"), 256).alias("h")).collect()]
    marked = [r.h for r in df.select(F.sha2(joined_text(["x", "y", "z"]), 256).alias("h")).collect()]
    assert compat[0] == compat[1] and marked[0] != marked[1]
    out = TR.add_row_id_and_hash(df.withColumn("hash_data", F.lit("keep")), ["x", "y"], key_cols=["x"])
    r = out.first()
    assert r.hash_data == "keep" and len(r.uuid) == 36


def test_standardize_and_normalize(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "` A b `long, `a_B` long")
    out = TR.standardize_table(df)
    assert out.columns == ["a_b", "a_b_2"] and out.count() == 1
    z = spark.createDataFrame([(0.0,), (0.0,)], "v double")
    assert TR.normalize_by_max(z, "v").first().v_normalized is None


def test_global_order_top_k(spark):
    df = spark.createDataFrame([(5,), (1,), (4,), (2,), (8,)], "v long")
    out = TR.global_order(df, [F.col("v")], limit=3)
    assert rows(out, "position", "v") == [(1, 1), (2, 2), (3, 4)]
    full = TR.global_order(df, [F.col("v").desc()], num_partitions=2)
    assert rows(full, "position", "v") == [(1, 8), (2, 5), (3, 4), (4, 2), (5, 1)]
