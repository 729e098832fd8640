"""Session construction and shared-folder helpers.

Operators never mutate session configuration; only ``build_session`` (used by
tests, bench and tools) sets configs.  Scratch output always goes below the
folder the cluster names in ``spark.checkpoint.dir`` so it is shared by all
executors and survives the loss of one.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_roots: dict[str, str] = {}       # application id -> folder made for a local session
_written: dict[str, list[str]] = {}   # application id -> scratch paths handed out


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tablekit", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.  A session on one
    machine (``local[...]``) may name none and gets a folder of its own,
    removed when the process ends; any other master without one is an error,
    because executors could not see each other's files."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _own_roots:
        _own_roots[sc.applicationId] = tempfile.mkdtemp(prefix="tablekit-ckpt-")
        atexit.register(shutil.rmtree, _own_roots[sc.applicationId], ignore_errors=True)
    return _own_roots[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/tablekit-{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete all scratch data of this session.  Call it once the results
    that read from it are written or collected."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def discard(df: DataFrame | None) -> None:
    """Delete one materialised table that nothing reads any more."""
    path = getattr(df, "_tk_path", None)
    if path:
        _delete(df.sparkSession, path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for driver-side helpers that need it."""
    return path[5:] if path.startswith("file:") else path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet below the shared checkpoint
    folder and reading it back: columnar, compressed, with size statistics
    for AQE, and readable by any executor after a failure.  A filter on the
    columns ``by`` (few values) reads only their folders."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, partitionBy=list(by) or None)
    out = spark.read.schema(df.schema).parquet(path)
    out._tk_path = path
    return out


def materialize_buckets(df: DataFrame, name: str, n: int, cols: tuple[str, ...]) -> DataFrame:
    """``materialize`` in ``n`` buckets by ``cols``: a join on all of them reads
    ``df`` without a shuffle.  Only tables have buckets; this one is known to
    the catalog just until it is read, its files stay."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"tablekit_{name}_{uuid.uuid4().hex}"
    df.repartition(n, *cols).write.format("parquet").bucketBy(n, *cols).option("path", path).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    out._tk_path = path
    return out
