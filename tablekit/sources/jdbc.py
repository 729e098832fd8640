"""JDBC source and sink (I02, I03) on Spark's JDBC data source.

No database is started by this package or its tests; these functions only
build the Spark reader/writer.  The JDBC driver jar must be on the
cluster's classpath.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

READ_FETCH_SIZE = 10000   # fixed value: JDBC read fetch size
WRITE_BATCH_SIZE = 10000  # fixed value: JDBC write batch size
WRITE_PARTITIONS = 8      # fixed value: parallel JDBC connections on write
WRITE_TIMEOUT_S = 3600    # fixed value: statement timeout on write


def jdbc_read_options(url: str, table: str | None = None, query: str | None = None,
                      where: str | None = None, derive: Mapping[str, str] | None = None,
                      partition: tuple[str, int, int, int] | None = None,
                      fetchsize: int = READ_FETCH_SIZE,
                      properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``.  Derived columns and the
    where clause are pushed into the source query; with ``partition`` =
    (column, lower, upper, n) the read runs on n parallel connections."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if table is not None and (derive or where):
        extra = "".join(f", {expr} AS {name}" for name, expr in (derive or {}).items())
        sql = f"SELECT *{extra} FROM {table}" + (f" WHERE {where}" if where else "")
        opts["dbtable"] = f"({sql}) src"
    elif table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query if not where else f"SELECT * FROM ({query}) q WHERE {where}"
    if partition is not None:
        col, lo, hi, n = partition
        if "query" in opts:
            opts["dbtable"] = f"({opts.pop('query')}) q"
        opts.update(partitionColumn=col, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(n))
    opts.update(dict(properties or {}))
    return opts


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **kwargs)).load()


def jdbc_write_options(url: str, table: str, num_partitions: int = WRITE_PARTITIONS,
                       batchsize: int = WRITE_BATCH_SIZE, isolation_level: str = "READ_COMMITTED",
                       query_timeout: int = WRITE_TIMEOUT_S,
                       properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Writer options only (partition bounds are read-side options)."""
    opts = {"url": url, "dbtable": table, "numPartitions": str(num_partitions),
            "batchsize": str(batchsize), "isolationLevel": isolation_level,
            "queryTimeout": str(query_timeout)}
    opts.update(dict(properties or {}))
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               num_partitions: int = WRITE_PARTITIONS, **kwargs) -> None:
    """Append or overwrite a JDBC table with at most ``num_partitions``
    connections (``coalesce``: no shuffle)."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    (df.coalesce(num_partitions).write.format("jdbc")
       .options(**jdbc_write_options(url, table, num_partitions=num_partitions, **kwargs))
       .mode(mode).save())
