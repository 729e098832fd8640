"""File-format jobs: format conversion (I10), table copy (I08) and
compaction with optional clustering / Z-order (I11)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import small_file_report
from .tables import _is_path, partition_columns, read_layout


# fixed values: common encoding names Spark's CSV reader spells differently
ENCODING_ALIASES = {"latin1": "iso-8859-1", "latin-1": "iso-8859-1", "cp1252": "windows-1252"}


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a finished Spark write (its ``_SUCCESS`` marker)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def publish(spark: SparkSession, staging: str, target: str) -> None:
    """Rename a finished ``staging`` directory to ``target``, which must not exist."""
    src, fs = _hadoop(spark, staging)
    dst, _ = _hadoop(spark, target)
    if dst.getParent() is not None:
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {staging} to {target}")


def remove_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def layout_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a ``k=v`` directory layout, in order, found by
    looking down one directory per level (never by listing all files)."""
    out: list[str] = []
    p, fs = _hadoop(spark, path)
    while True:
        names = [s.getPath() for s in fs.globStatus(type_path(spark, p, "*=*")) or []]
        if not names:
            return out
        escaped = names[0].getName().split("=", 1)[0]
        out.append(spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(escaped))
        p = names[0]


def type_path(spark: SparkSession, parent, child: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent, child)


# CSV that gives every text back: NULL and '' apart, blanks, quotes and line breaks kept.
# A text that is the marker itself is the one that cannot be told from NULL.
CSV_NULL = "\\N"
CSV_WRITE = {"header": "true", "nullValue": CSV_NULL, "emptyValue": '""', "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
CSV_READ_BACK = CSV_WRITE | {"emptyValue": "", "multiLine": "true"}


def convert_format(spark: SparkSession, src: str, dst: str, src_fmt: str, dst_fmt: str,
                   read_options: Mapping[str, str] | None = None,
                   write_options: Mapping[str, str] | None = None, schema=None,
                   mode: str = "errorifexists") -> DataFrame:
    """Read ``src`` in one format (csv, json, parquet, text, orc; CSV with
    header and an ``encoding`` option such as latin1) and write ``dst`` in
    another.  A CSV target keeps every row and text (``CSV_WRITE``; write
    options override it).  Returns a DataFrame over the written output."""
    ropts = {"header": "true"} if src_fmt == "csv" else {}
    ropts.update(dict(read_options or {}))
    enc = ropts.get("encoding")
    if enc and enc.lower().replace("_", "-") in ENCODING_ALIASES:
        ropts["encoding"] = ENCODING_ALIASES[enc.lower().replace("_", "-")]
    reader = spark.read.format(src_fmt).options(**ropts)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(src)
    given = dict(write_options or {})
    wopts = (CSV_WRITE if dst_fmt == "csv" else {}) | given
    df.write.format(dst_fmt).options(**wopts).mode(mode).save(dst)
    back = spark.read.format(dst_fmt).options(**((CSV_READ_BACK if dst_fmt == "csv" else {}) | given))
    if dst_fmt in ("csv", "json"):
        back = back.schema(df.schema)
    return back.load(dst)


def copy_table_if_absent(spark: SparkSession, source: str, target_path: str,
                         fmt: str = "parquet") -> DataFrame:
    """Physical copy of a table (catalog name or path) keeping its partition
    layout, only when no finished copy exists (one with ``_SUCCESS``; it is
    never overwritten).  The copy is written beside the target and renamed
    when done; what an aborted copy left at the target is replaced.  Returns
    a one-row report (status COPIED, REPLACED or EXISTS)."""
    if is_complete(spark, target_path):
        status = "EXISTS"
    else:
        df = spark.table(source) if not _is_path(source) else read_layout(spark, source, fmt)
        parts = partition_columns(spark, source)
        staging = f"{target_path.rstrip('/')}__copying"
        w = df.write.format(fmt).mode("overwrite")
        if parts:
            w = w.partitionBy(*parts)
        w.save(staging)
        status = "COPIED"
        if path_exists(spark, target_path):
            remove_path(spark, target_path)
            status = "REPLACED"
        publish(spark, staging, target_path)
    return spark.range(1).select(F.lit(source).alias("source"), F.lit(target_path).alias("target"),
                                 F.lit(status).alias("status"))


TEXT_SAMPLES = 64  # sampled texts for each of the 2^bits buckets of a text column
TEXT_PREFIX = 64   # bytes of a text that place it in a bucket (longer common beginnings share one)


def _text_key(c: Column) -> Column:
    """The first bytes of a text or binary value, as UTF-8 orders them."""
    return F.substring(F.coalesce(c.cast("binary"), F.lit(b"")), 1, TEXT_PREFIX)


def _text_bounds(df: DataFrame, c: str, n: int) -> list[bytes]:
    """Borders that cut the values into ``n`` about equal ranges, from a sample
    of about ``TEXT_SAMPLES * n`` of them, whatever the size of the table."""
    rows = df.count()
    share = min(1.0, TEXT_SAMPLES * n / max(1, rows))
    key = df.select(_text_key(F.col(c)).alias("k"))
    held = sorted(bytes(r["k"]) for r in (key.sample(share, seed=7) if share < 1 else key).collect())
    return [held[len(held) * i // n] for i in range(1, n)] if held else []


def _morton_udf(bounds: list[list], bits: int):
    """Arrow UDF: range bucket of each column by binary search in its
    quantile bounds (numpy ``searchsorted``; texts by their first bytes), bits
    interleaved into one long.  ``bounds`` is 2^bits values per column: bounded
    closure size."""
    arrs = [np.array(b, dtype=object) if b and isinstance(b[0], bytes) else np.asarray(b, dtype="float64") for b in bounds]

    @F.arrow_udf(T.LongType())
    def morton(packed: pa.Array) -> pa.Array:
        cols = [packed.field(i) for i in range(len(arrs))]
        z = np.zeros(len(packed), dtype=np.int64)
        k = len(cols)
        for i, (c, b) in enumerate(zip(cols, arrs)):
            if b.dtype == object:
                v = np.array(c.to_pylist(), dtype=object)
            else:
                v = c.to_numpy(zero_copy_only=False).astype("float64")
                v = np.where(np.isnan(v), -np.inf, v)
            bucket = np.searchsorted(b, v, side="left").astype(np.int64)
            for j in range(bits):
                z |= ((bucket >> j) & 1) << (j * k + i)
        return pa.array(z, type=pa.int64())

    return morton


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = 8,
               relative_error: float = 0.001) -> Column:
    """Morton (Z-order) key: each column is mapped to its range bucket
    0..2^bits-1 from approximate quantiles (one aggregate job over all
    columns; from a sample for texts), then the bucket bits are interleaved
    (vectorised Arrow UDF).  All columns keep their order, texts that of their
    first ``TEXT_PREFIX`` bytes."""
    n = 1 << bits
    probs = [i / n for i in range(1, n)]
    keyed = []
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        if dt in ("string", "binary"):
            keyed.append(_text_key(F.col(c)))
        elif dt.startswith("date"):
            keyed.append(F.unix_date(F.col(c)).cast("double"))
        elif dt.startswith("timestamp"):
            keyed.append(F.unix_micros(F.col(c).cast("timestamp")).cast("double"))
        else:
            keyed.append(F.col(c).cast("double"))
    texts = {i for i, c in enumerate(cols) if df.schema[c].dataType.simpleString() in ("string", "binary")}
    numbers = [F.percentile_approx(k, probs, int(1 / relative_error)).alias(f"b{i}") for i, k in enumerate(keyed) if i not in texts]
    row = df.agg(*numbers).first() if numbers else None
    bounds = [_text_bounds(df, cols[i], n) if i in texts else [float(b) for b in (row[f"b{i}"] or [])] for i in range(len(keyed))]
    return _morton_udf(bounds, bits)(F.struct(*[k.alias(f"c{i}") for i, k in enumerate(keyed)]))


def compact_table(spark: SparkSession, path: str, out: str, target_mb: float = 128.0,
                  where: str | None = None, cluster_by: Sequence[str] | None = None,
                  zorder: bool = False, fmt: str = "parquet") -> DataFrame:
    """Rewrite a directory into files near ``target_mb`` in ``out``, optionally
    range-clustered on ``cluster_by`` or on their Z-order key, keeping its
    partition layout.  With ``where`` (on partition columns) only the matching
    partitions are rewritten, in place: they are staged in ``out`` and put
    back by dynamic partition overwrite, the others stay untouched.  Partition
    columns are text there (``p = '01'`` is not ``p = '1'``).  Returns
    before/after file metrics of what was rewritten."""
    parts = layout_columns(spark, path)
    df = read_layout(spark, path, fmt)
    if where:
        if not parts:
            raise ValueError("where selects partitions; the directory has none")
        df = df.filter(F.expr(where))
    suffix = f".{fmt}"
    sizes = df.select("_metadata.file_path", "_metadata.file_size").distinct() if where else None
    before = (sizes.agg(F.count(F.lit(1)).alias("num_files"), F.sum("file_size").alias("total_bytes")) if where
              else small_file_report(spark, path, target_mb, suffix=suffix)).first()
    total = (before["total_bytes"] if before else 0) or 0
    n = max(1, math.ceil(total / (target_mb * 1024 * 1024)))
    if cluster_by and zorder:
        data = df.withColumn("_tk_z", zorder_key(df, cluster_by))
        data = data.repartitionByRange(n, *parts, "_tk_z").sortWithinPartitions(*parts, "_tk_z").drop("_tk_z")
    elif cluster_by:
        data = df.repartitionByRange(n, *parts, *cluster_by).sortWithinPartitions(*parts, *cluster_by)
    elif parts:
        # whole partitions side by side; a partition larger than a share is cut by a hash of the row
        others = [c for c in df.columns if c not in parts]
        data = df.repartitionByRange(n, *parts, F.xxhash64(*others) if others else F.lit(0))
    else:
        data = df.repartition(n)
    w = data.write.format(fmt).mode("errorifexists")
    (w.partitionBy(*parts) if parts else w).save(out)
    after = small_file_report(spark, out, target_mb, suffix=suffix).first()
    if where:
        staged = spark.read.format(fmt).schema(df.schema).load(out)
        (staged.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*parts).save(path))

    def row(stage: str, r) -> tuple:
        files, size = (r["num_files"], r["total_bytes"] or 0) if r else (0, 0)
        return stage, files, size, size / files / (1024.0 * 1024.0) if files else 0.0

    return spark.createDataFrame([row("before", before), row("after", after)],
                                 "stage string, num_files long, total_bytes long, avg_file_mb double")
