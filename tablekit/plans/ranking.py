"""Global ordering without a single-task window.

``Window.orderBy(...)`` with no partition runs in one task.  Instead we range
partition on the (unique) order, number rows inside each partition with
``monotonically_increasing_id`` (partition index in the high bits, row index
in the low 33 bits) and add the row count of all earlier partitions.  The
per-partition count table has one row per partition, so its broadcast is
bounded by the partition count, not by the data.

The range partitioner samples its bounds with a seed tied to the RDD id, so
two plans over the same input would disagree on partition boundaries.  The
numbered rows (partition id and local index as columns) are therefore
written once as Parquet in the shared ``spark.checkpoint.dir`` folder and
both the counts and the rows are read from there: consistent, and safe
under executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW_BITS = (1 << 33) - 1


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_positions(df: DataFrame, order: list[Column], pos_col: str = "position",
                     total_col: str | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col`` = 1..n in ``order`` (which must be unique per row for a
    deterministic answer).  Optionally add ``total_col`` = n."""
    n = _partitions(df, num_partitions)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()  # partition index << 33 | row index
    tagged = (ranged.withColumn("_tk_mid", mid)
              .withColumn("_tk_pid", F.shiftright(F.col("_tk_mid"), 33))
              .withColumn("_tk_local", F.col("_tk_mid").bitwiseAND(F.lit(_LOW_BITS)))
              .drop("_tk_mid"))
    tagged = materialize(tagged, "positions")
    counts = tagged.groupBy("_tk_pid").agg(F.count(F.lit(1)).alias("_tk_n"))
    # one row per partition: a single-task window here is bounded and tiny
    before = Window.orderBy("_tk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tk_pid",
        F.coalesce(F.sum("_tk_n").over(before), F.lit(0)).alias("_tk_off"),
        F.sum("_tk_n").over(Window.partitionBy()).alias("_tk_total"),
    )
    out = (tagged.join(F.broadcast(offsets), "_tk_pid")
           .withColumn(pos_col, F.col("_tk_off") + F.col("_tk_local") + F.lit(1)))
    if total_col:
        out = out.withColumn(total_col, F.col("_tk_total"))
    return out.drop("_tk_pid", "_tk_local", "_tk_off", "_tk_total")


def ntile_expr(pos: Column, total: Column, k: int) -> Column:
    """SQL NTILE(k) from a 1-based position and the row count: the first
    ``total mod k`` tiles hold one row more."""
    q = F.floor(total / F.lit(k))
    r = total - q * F.lit(k)
    big = r * (q + 1)
    return (F.when(total < F.lit(k), pos)
            .when(pos <= big, F.ceil(pos / (q + 1)))
            .otherwise(r + F.ceil((pos - big) / q))).cast("int")

