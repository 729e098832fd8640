"""Deduplication and insert-only merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._util import as_list, null_safe_on, order_cols


def _first_rows(df: DataFrame, keys: Sequence[str], order_by) -> DataFrame:
    # row_number() = 1 plans as partial + final WindowGroupLimit: each map
    # task keeps one row per key before the shuffle, so a hot key costs one
    # row per input partition, not a third of the table in one task.
    w = Window.partitionBy(*keys).orderBy(*order_cols(order_by))
    return df.withColumn("_tk_rn", F.row_number().over(w)).filter("_tk_rn = 1").drop("_tk_rn")


def dedup_keep_first(df: DataFrame, keys: str | Sequence[str],
                     order_by: Sequence[str | Column] | str) -> DataFrame:
    """The table without every row after the first per key (earliest by
    ``order_by``, which should end in a unique tie-break).  NULL keys form
    one group."""
    return _first_rows(df, as_list(keys), order_by)


def find_duplicates(df: DataFrame, keys: str | Sequence[str],
                    order_by: Sequence[str | Column] | str) -> DataFrame:
    """Every row after the first per key, exact copies included (the rows with
    ``row_number() > 1``).  Ties of ``order_by`` go by the other columns.

    Identical rows are first counted (map-side), so a flood of copies is one
    row; the first row of each key (a map-side limit, see
    ``dedup_keep_first``) then gives one copy away, and the rest come back as
    often as counted.  A hot key is spread by the whole row, never gathered
    in one window task."""
    keys = as_list(keys)
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
    rest = [F.col(c).asc_nulls_last() for c in df.columns]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_tk_n"))
    w = Window.partitionBy(*keys).orderBy(*by, *rest)
    firsts = counted.withColumn("_tk_rn", F.row_number().over(w)).filter("_tk_rn = 1").select(*df.columns)
    renamed, cond = null_safe_on(counted, firsts.withColumn("_tk_one", F.lit(1)), df.columns, extra=["_tk_one"])
    left = counted.join(renamed, cond, "left").withColumn("_tk_n", F.col("_tk_n") - F.coalesce(F.col("_tk_one"), F.lit(0)))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_tk_n")))
    return left.filter("_tk_n > 0").select(*df.columns, copies.alias("_tk_copy")).drop("_tk_copy")


def dedup_partition(spark: SparkSession, path: str, partition_col: str, value,
                    keys: str | Sequence[str], order_by, staging_path: str) -> DataFrame:
    """Rewrite one partition of a partitioned Parquet directory without
    duplicates; every other partition is left untouched.

    The partition is read with partition pruning, deduplicated and written to
    ``staging_path`` first (never read and overwrite one path in a single
    plan), then written back with dynamic partition overwrite, which replaces
    only the partition present in the data.  ``value`` is compared as the
    text of the partition's folder (``01`` is not ``1``; None is the default
    partition).  Returns the re-read partition, its column as text."""
    from ..sources.tables import as_partition_text, read_layout
    here = F.col(partition_col).eqNullSafe(as_partition_text(F.lit(value)))
    part = read_layout(spark, path).filter(here)
    clean = dedup_keep_first(part, keys, order_by)
    clean.write.mode("overwrite").parquet(staging_path)
    staged = spark.read.schema(part.schema).parquet(staging_path)
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(path))
    return read_layout(spark, path).filter(here)


def merge_insert_new(target: DataFrame, staging: DataFrame, keys: str | Sequence[str],
                     order_by) -> DataFrame:
    """``MERGE ... WHEN NOT MATCHED THEN INSERT`` as a plan: staging rows,
    deduplicated by key (first by ``order_by``), whose key is absent from the
    target, appended to the target.  Target rows are never updated and
    target duplicates remain.  Keys compare with ``=`` (NULL never matches)."""
    keys = as_list(keys)
    fresh = dedup_keep_first(staging, keys, order_by).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))
