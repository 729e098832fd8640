"""Data-quality checks.

Each check is one distributed aggregate returning a small metrics
DataFrame; where rows can offend, a second function returns them.  A
pass/fail answer is ``status == 'OK'`` in the metrics.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import as_list


# ---------------------------------------------------------------- Q01
def null_ratio_check(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Per column: null count, total, ratio, threshold and status
    (EMPTY_DF, MISSING_COLUMN, FAIL when ratio > threshold, else OK).
    One pass over the data for all columns; unpivoted by exploding an array
    of per-column structs."""
    present = [c for c in thresholds if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_tk_total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_tk_n{i}") for i, c in enumerate(present)]
    one = df.agg(*aggs)
    rows = []
    for name, thr in thresholds.items():
        if name in present:
            i = present.index(name)
            nulls = F.col(f"_tk_n{i}")
        else:
            nulls = F.lit(None).cast("long")
        rows.append(F.struct(F.lit(name).alias("column_name"), nulls.alias("null_count"),
                             F.lit(float(thr)).alias("threshold"),
                             F.lit(name in present).alias("_tk_present")))
    exploded = one.select("_tk_total", F.explode(F.array(*rows)).alias("_tk_r")).select(
        "_tk_total", "_tk_r.*")
    total = F.col("_tk_total")
    ratio = F.when(F.col("_tk_present") & (total > 0),
                   F.col("null_count").cast("double") / total.cast("double"))
    status = (F.when(total == 0, "EMPTY_DF")
               .when(~F.col("_tk_present"), "MISSING_COLUMN")
               .when(ratio > F.col("threshold"), "FAIL").otherwise("OK"))
    return exploded.select("column_name", "null_count", total.alias("total_count"),
                           ratio.alias("null_ratio"), "threshold", status.alias("status"))


def null_ratio_ok(metrics: DataFrame) -> DataFrame:
    """One row: overall OK only if every listed column is OK."""
    return metrics.agg(F.coalesce(F.bool_and(F.col("status") == "OK"), F.lit(False)).alias("ok"))


# ---------------------------------------------------------------- Q02
def number_range_check(df: DataFrame, column: str, min_value: float | None = None,
                       max_value: float | None = None) -> DataFrame:
    """Rows below ``min_value`` / above ``max_value`` (bounds inclusive, NULLs
    never violate), actual min and max, status — one conditional aggregate."""
    c = F.col(column)
    below = F.count_if(c < F.lit(min_value)) if min_value is not None else F.lit(0).cast("long")
    above = F.count_if(c > F.lit(max_value)) if max_value is not None else F.lit(0).cast("long")
    m = df.agg(below.alias("below_count"), above.alias("above_count"),
               F.min(c).cast("double").alias("actual_min"), F.max(c).cast("double").alias("actual_max"))
    return m.select(F.lit(column).alias("column_name"),
                    F.lit(min_value).cast("double").alias("min_value"),
                    F.lit(max_value).cast("double").alias("max_value"),
                    "below_count", "above_count", "actual_min", "actual_max",
                    F.when((F.col("below_count") + F.col("above_count")) == 0, "OK")
                     .otherwise("FAIL").alias("status"))


def number_range_violations(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    c = F.col(column)
    cond = F.lit(False)
    if min_value is not None:
        cond = cond | (c < F.lit(min_value))
    if max_value is not None:
        cond = cond | (c > F.lit(max_value))
    return df.filter(cond)


# ---------------------------------------------------------------- Q03
def _as_date(df: DataFrame, column: str, fmt: str | None) -> Column:
    dt = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dt, T.StringType):
        return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)
    return c.cast("date")


def date_range_check(df: DataFrame, column: str, min_date: str, max_date: str,
                     fmt: str | None = None) -> DataFrame:
    """Rows with a date outside [min_date, max_date] (inclusive); the column
    may be string (parsed with ``fmt``), date or timestamp.  NULL and
    unparsable values are counted apart.  Metrics, never an exception."""
    d = _as_date(df, column, fmt)
    lo, hi = F.lit(min_date).cast("date"), F.lit(max_date).cast("date")
    m = df.agg(F.count_if(d < lo).alias("below_count"), F.count_if(d > hi).alias("above_count"),
               F.count_if(d.isNull()).alias("invalid_count"),
               F.min(d).alias("actual_min"), F.max(d).alias("actual_max"))
    return m.select(F.lit(column).alias("column_name"), lo.alias("min_date"), hi.alias("max_date"),
                    "below_count", "above_count", "invalid_count", "actual_min", "actual_max",
                    F.when((F.col("below_count") + F.col("above_count")) == 0, "OK")
                     .otherwise("FAIL").alias("status"))


def date_range_violations(df: DataFrame, column: str, min_date: str, max_date: str,
                          fmt: str | None = None) -> DataFrame:
    d = _as_date(df, column, fmt)
    return df.filter((d < F.lit(min_date).cast("date")) | (d > F.lit(max_date).cast("date")))


# ---------------------------------------------------------------- Q04
def partition_skew(df: DataFrame, cols: str | Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Rows per key value; largest count, mean count, ratio largest/mean and
    whether it exceeds ``threshold``.  NULL keys are a group.  Two partial
    aggregates; the second runs over one row per distinct key."""
    cols = as_list(cols)
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_tk_n"))
    m = per.agg(F.count(F.lit(1)).alias("distinct_keys"), F.max("_tk_n").alias("max_count"),
                F.avg("_tk_n").alias("avg_count"))
    ratio = F.try_divide(F.col("max_count").cast("double"), F.col("avg_count"))
    return m.select(F.lit(",".join(cols)).alias("columns"), "distinct_keys", "max_count",
                    "avg_count", ratio.alias("skew_ratio"),
                    F.coalesce(ratio > F.lit(threshold), F.lit(False)).alias("is_skewed"))


def partition_skew_keys(df: DataFrame, cols: str | Sequence[str], top: int = 10) -> DataFrame:
    """The ``top`` heaviest key values with their share of the rows."""
    cols = as_list(cols)
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return (per.orderBy(F.col("row_count").desc()).limit(top)
               .withColumn("share", F.col("row_count") / total))


# ---------------------------------------------------------------- Q07
def table_freshness(df: DataFrame, as_of: str, ts: str | None = None) -> DataFrame:
    """Last modification and its age in days.  With ``ts`` it is the maximum
    of that event column; otherwise the newest data-file modification time
    (``_metadata.file_modification_time``), which needs no table format."""
    if ts is not None:
        last = F.max(F.col(ts))
    else:
        last = F.max(F.col("_metadata.file_modification_time"))
    m = df.agg(last.alias("last_modified"))
    return m.select("last_modified",
                    F.datediff(F.lit(as_of).cast("date"),
                               F.col("last_modified").cast("date")).alias("age_days"))


# ---------------------------------------------------------------- Q08
def small_file_report(spark: SparkSession, path: str, target_mb: float = 128.0, max_files: int = 5000,
                      by: str | Sequence[str] | None = None, suffix: str = ".parquet") -> DataFrame:
    """Files, bytes and average MB of the data files below ``path`` (optionally
    per partition column of a ``k=v`` layout), with two independent
    recommendations: average below ``target_mb`` and more than ``max_files``
    files.  Files are listed, not read (the ``binaryFile`` source gives path
    and length without content), so empty files count too."""
    by = as_list(by)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"*{suffix}").load(path).select("path", "length"))
    parts = [F.regexp_extract("path", f"/{re.escape(c)}=([^/]*)/", 1).alias(c) for c in by]
    m = files.select(*parts, "length").groupBy(*by).agg(F.count(F.lit(1)).alias("num_files"),
                                                        F.sum("length").alias("total_bytes"))
    avg_mb = F.coalesce(F.try_divide(F.col("total_bytes").cast("double"),
                                     F.col("num_files") * F.lit(1024.0 * 1024.0)), F.lit(0.0))
    return (m.withColumn("avg_file_mb", avg_mb)
             .withColumn("small_files", F.col("avg_file_mb") < F.lit(target_mb))
             .withColumn("too_many_files", F.col("num_files") > F.lit(max_files))
             .withColumn("needs_compaction", F.col("small_files") | F.col("too_many_files")))


# ---------------------------------------------------------------- Q09
def duplicate_check(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Number of key values that repeat and the surplus rows they carry."""
    keys = as_list(keys)
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tk_n"))
    m = per.agg(F.count_if(F.col("_tk_n") > 1).alias("duplicated_keys"),
                F.coalesce(F.sum(F.col("_tk_n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
                F.coalesce(F.sum("_tk_n"), F.lit(0)).cast("long").alias("total_rows"))
    return m.withColumn("status", F.when(F.col("duplicated_keys") == 0, "OK").otherwise("FAIL"))


# ---------------------------------------------------------------- Q10
def referential_integrity(child: DataFrame, parent: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Child rows whose key has no parent row (left anti join; a NULL child
    key is an orphan).  ``on`` = shared names or {child_col: parent_col}."""
    if isinstance(on, Mapping):
        pairs = list(on.items())
    else:
        pairs = [(c, c) for c in as_list(on)]
    p = parent.select(*[F.col(pc).alias(f"_tk_p{i}") for i, (_, pc) in enumerate(pairs)])
    cond = None
    for i, (cc, _) in enumerate(pairs):
        e = child[cc] == p[f"_tk_p{i}"]
        cond = e if cond is None else cond & e
    return child.join(p, cond, "left_anti")


# ---------------------------------------------------------------- Q11
def row_count_compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target row counts and whether they are equal, in one job
    over the union of both (no cross join of two counts)."""
    u = source.select(F.lit(0).alias("_tk_side")).unionByName(target.select(F.lit(1).alias("_tk_side")))
    m = u.agg(F.count_if(F.col("_tk_side") == 0).alias("source_count"),
              F.count_if(F.col("_tk_side") == 1).alias("target_count"))
    return m.withColumn("counts_equal", F.col("source_count") == F.col("target_count"))


# ---------------------------------------------------------------- Q12
def schema_check(df: DataFrame, expected: T.StructType, count_castable: bool = True) -> DataFrame:
    """One row per expected column: expected and actual type and status
    (OK, MISSING, TYPE_MISMATCH) plus, for mismatches, how many non-NULL
    values cannot be cast to the expected type (``try_cast``).  Extra columns
    are listed as EXTRA.  The per-row counts are one aggregate."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    fail_aggs = []
    for f in expected.fields:
        a = actual.get(f.name)
        if a is None:
            status = "MISSING"
        elif a == f.dataType:
            status = "OK"
        else:
            status = "TYPE_MISMATCH"
            if count_castable:
                c = F.col(f.name)
                fail_aggs.append(F.count_if(c.isNotNull() & c.try_cast(f.dataType).isNull())
                                 .alias(f"_tk_f_{len(fail_aggs)}"))
        rows.append((f.name, f.dataType.simpleString(), a.simpleString() if a else None, status))
    for name, a in actual.items():
        if name not in {f.name for f in expected.fields}:
            rows.append((name, None, a.simpleString(), "EXTRA"))
    counts = df.agg(*fail_aggs) if fail_aggs else df.sparkSession.range(1).select()
    structs, k = [], 0
    for name, exp, act, status in rows:
        if status == "TYPE_MISMATCH" and count_castable:
            bad = F.col(f"_tk_f_{k}")
            k += 1
        else:
            bad = F.lit(None).cast("long")
        structs.append(F.struct(F.lit(name).alias("column_name"), F.lit(exp).cast("string").alias("expected_type"),
                                F.lit(act).cast("string").alias("actual_type"), F.lit(status).alias("status"),
                                bad.alias("uncastable_rows")))
    return counts.select(F.explode(F.array(*structs)).alias("_tk_r")).select("_tk_r.*")
