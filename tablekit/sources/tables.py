"""Reading tables by name or path (I01)."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def _is_path(name: str) -> bool:
    return "/" in name or name.startswith(("file:", "s3", "abfss:", "gs:", "hdfs:"))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a catalog table, or of a ``k=v`` directory layout
    (one directory a level is looked at, files are not listed)."""
    if not _is_path(name):
        return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    from .files import layout_columns
    return layout_columns(spark, name)


def read_layout(spark: SparkSession, path: str, fmt: str = "parquet",
                declared: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """A ``k=v`` directory whose partition columns have their declared type, or
    else text.  Spark's own guess re-types them: ``01`` would become 1, and a
    rewrite would then add ``p=1`` beside ``p=01``."""
    df = spark.read.format(fmt).load(path)
    parts = {c.lower() for c in partition_columns(spark, path)}
    if not parts:
        return df
    declared = {k.lower(): v for k, v in (declared or {}).items()}
    schema = T.StructType([T.StructField(f.name, declared.get(f.name.lower(), T.StringType()) if f.name.lower() in parts else f.dataType)
                           for f in df.schema.fields])
    return spark.read.format(fmt).schema(schema).load(path)


def as_partition_text(c: Column) -> Column:
    """A value as the text of its partition folder; empty text is NULL there."""
    return F.nullif(c.cast("string"), F.lit(""))


def partition_folder(spark: SparkSession, values: Mapping[str, object]) -> str:
    """``k=v/...`` with Spark's own escaping of names and values."""
    path = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(path.getPartitionPathString(k, None if v is None else str(v)) for k, v in values.items())


def read_table(spark: SparkSession, name: str, partition_filters: Mapping[str, object] | None = None,
               where: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A table by catalog name or path, with equality filters on partition
    columns (pruned at planning; filters on other columns are ignored with a
    warning) and an optional SQL predicate."""
    df = spark.table(name) if not _is_path(name) else spark.read.format(fmt).load(name)
    if partition_filters:
        parts = set(partition_columns(spark, name))
        for col, value in partition_filters.items():
            if col in parts:
                df = df.filter(F.col(col) == F.lit(value))
            else:
                log.warning("ignoring filter on %s: not a partition column of %s", col, name)
    if where:
        df = df.filter(F.expr(where))
    return df


def standard_table_name(name: str, prefix: str | None = None) -> str:
    base = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()
    return f"{prefix.lower()}_{base}" if prefix else base


def analyze_columns(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """Refresh catalog statistics (row count, size and per-column min/max,
    distinct and null counts) that the cost-based optimiser and AQE use:
    ``ANALYZE TABLE ... COMPUTE STATISTICS [FOR COLUMNS ...]``.  Returns the
    table-level statistics row of ``DESCRIBE TABLE EXTENDED``."""
    quoted = ", ".join(f"`{c}`" for c in columns or [])
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (f" FOR COLUMNS {quoted}" if quoted else ""))
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Statistics")
