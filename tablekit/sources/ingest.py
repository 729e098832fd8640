"""Ingestion jobs into a lake directory (I04-I07) and log parsing (I09)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators._util import as_list, null_safe_on, order_cols
from .files import path_exists, remove_path
from .tables import as_partition_text, partition_folder, read_layout, standard_table_name

REPORT_SCHEMA = ("source string, table string, target string, mode string, records long, "
                 "status string, run_utc timestamp_ntz")


def _report(spark: SparkSession, source: str, table: str, target: str, mode: str,
            records: int | None, status: str) -> DataFrame:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(source, table, target, mode, records, status, now)], REPORT_SCHEMA)


def target_name(table: str, source: str | None) -> str:
    """Standardised table name with the source prefix."""
    return standard_table_name(table, source)


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] | None) -> int:
    obs = Observation("tk_ingest")
    observed = df.observe(obs, F.count(F.lit(1)).alias("records"))
    w = observed.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["records"])


def ingest_full(df: DataFrame, target: str, drop_cols: Sequence[str] = (),
                partition_by: Sequence[str] | None = None, source: str = "", table: str = "") -> DataFrame:
    """Overwrite ``target`` with ``df`` minus sensitive columns; the record
    count comes from an ``observe`` metric of the same write (no second
    scan).  Returns the run-report row."""
    out = df.drop(*as_list(drop_cols))
    n = _write(out, target, "overwrite", partition_by)
    return _report(df.sparkSession, source, table, target, "full", n, "SUCCESS")


def ingest_compare(df: DataFrame, target: str, drop_cols: Sequence[str] = (),
                   partition_by: Sequence[str] | None = None, source: str = "", table: str = "") -> DataFrame:
    """Full reload only when the source and target row counts differ."""
    spark = df.sparkSession
    if path_exists(spark, target):
        counts = (df.select(F.lit(0).alias("s"))
                    .unionByName(spark.read.parquet(target).select(F.lit(1).alias("s")))
                    .agg(F.count_if(F.col("s") == 0).alias("a"), F.count_if(F.col("s") == 1).alias("b"))
                    .first())
        if counts["a"] == counts["b"]:
            return _report(spark, source, table, target, "compare", counts["a"], "SKIPPED")
    rep = ingest_full(df, target, drop_cols, partition_by, source, table)
    return rep.withColumn("mode", F.lit("compare"))


def ingest_incremental(df: DataFrame, target: str, watermark_col: str, drop_cols: Sequence[str] = (),
                       partition_by: Sequence[str] | None = None, source: str = "", table: str = "",
                       keys: str | Sequence[str] | None = None) -> DataFrame:
    """Append the rows past the target's high-water mark (max of
    ``watermark_col``); a missing target is loaded in full.  Rows *at* the
    mark, and rows without one, may or may not have arrived before: they are
    appended unless the target has their ``keys`` (default: the whole row,
    NULLs equal)."""
    spark = df.sparkSession
    out = df.drop(*as_list(drop_cols))
    if not path_exists(spark, target):
        n = _write(out, target, "overwrite", partition_by)
        return _report(spark, source, table, target, "incremental", n, "SUCCESS")
    known = read_layout(spark, target, declared={f.name: f.dataType for f in out.schema.fields})
    mark = known.agg(F.max(watermark_col)).scalar()
    w = F.col(watermark_col)
    at = w.isNull() | (w == mark) | mark.isNull()
    fresh, border, there = out.filter(w > mark), out.filter(at), known.filter(at)
    cols = as_list(keys) or out.columns
    renamed, cond = null_safe_on(border, there, cols)
    n = _write(fresh.unionByName(border.join(renamed, cond, "left_anti")), target, "append", partition_by)
    return _report(spark, source, table, target, "incremental", n, "SUCCESS")


def upsert(target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], tie_break=None) -> DataFrame:
    """Upsert by key, incoming row wins: incoming rows plus the target rows
    whose key is not incoming (anti join, no full outer join).  Of several
    incoming rows with one key the first by ``tie_break`` (then by all
    columns) is kept; NULL keys count as equal."""
    keys = as_list(keys)
    order = [*order_cols(tie_break), *order_cols(incoming.columns)]
    first = Window.partitionBy(*keys).orderBy(*order)
    once = incoming.withColumn("_tk_rn", F.row_number().over(first)).filter("_tk_rn = 1").drop("_tk_rn")
    renamed, cond = null_safe_on(target, incoming, keys)
    return once.unionByName(target.join(renamed, cond, "left_anti").select(*incoming.columns))


def ingest_merge(incoming: DataFrame, target: str, keys: str | Sequence[str], staging: str,
                 partition_by: Sequence[str] | None = None, source: str = "", table: str = "",
                 tie_break=None) -> DataFrame:
    """Upsert ``incoming`` into the target directory.  Merged rows are written
    to ``staging`` first, so no plan reads and overwrites the same path.

    With ``partition_by`` only the partitions that change are rewritten (by
    dynamic partition overwrite): those that receive rows, and those that
    lose a row because its key moved.  Partition values compare, and are
    written, as the text of their folders (``01`` is not ``1``).  Without it the
    whole table is one partition.  The report counts the rows written."""
    spark = incoming.sparkSession
    if not path_exists(spark, target):
        empty = incoming.limit(0)
        n = _write(upsert(empty, incoming, keys, tie_break), target, "overwrite", partition_by)
        return _report(spark, source, table, target, "merge", n, "SUCCESS")
    known = read_layout(spark, target)
    if not partition_by:
        _write(upsert(known, incoming, keys, tie_break), staging, "overwrite", None)
        n = _write(spark.read.parquet(staging), target, "overwrite", None)
        return _report(spark, source, table, target, "merge", n, "SUCCESS")
    parts = list(partition_by)
    incoming = incoming.withColumns({p: as_partition_text(F.col(p)) for p in parts})
    renamed, cond = null_safe_on(known, incoming, as_list(keys))
    losing = known.select(*dict.fromkeys([*as_list(keys), *parts])).join(renamed, cond, "left_semi").select(*parts)
    touched = incoming.select(*parts).unionByName(losing).distinct()
    renamed, cond = null_safe_on(known, touched, parts)
    _write(upsert(known.join(renamed, cond, "left_semi").select(*known.columns), incoming.select(*known.columns), keys, tie_break),
           staging, "overwrite", parts)
    staged = spark.read.schema(known.schema).parquet(staging)
    # a partition that lost all its rows has nothing to overwrite it with
    renamed, cond = null_safe_on(losing, staged.select(*parts).distinct(), parts)
    emptied = losing.distinct().join(renamed, cond, "left_anti")
    gone = [dict(r.asDict()) for r in emptied.toLocalIterator()]
    n = _write_dynamic(staged.select(*known.columns), target, parts)
    for values in gone:
        remove_path(spark, f"{target.rstrip('/')}/{partition_folder(spark, {p: values[p] for p in parts})}")
    return _report(spark, source, table, target, "merge", n, "SUCCESS")


def _write_dynamic(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    obs = Observation("tk_ingest")
    observed = df.observe(obs, F.count(F.lit(1)).alias("records"))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return int(obs.get["records"])
