"""Per-key ordered scans (lag, lead, running sums) that survive a hot key.

``Window.partitionBy(key)`` sends every row of a key to one task; if one key
holds a third of the table, that task holds a third of the table.  Here:

1. one partial aggregate looks for *hot* keys, those with more than
   ``rows_per_segment`` rows.  Without any, the scans are plain windows;
2. otherwise the rows are cut into segments of about ``rows_per_segment``
   rows along the whole order (key, time, tie-breaks, row number): Spark's
   range partitioner samples that order, so neither a hot key nor a flood of
   its rows at one instant, nor equal rows, ever form one segment.  The
   segmented rows are written once, with their segment and row number;
3. the window runs per (key, segment) - balanced tasks;
4. the values that cross a segment border (last value of the previous
   segment, first value of the next, prefix sums of earlier segments) come
   from a per-(key, segment) summary of the few keys at segment ends (at most
   two a segment), aggregated on the already co-partitioned rows and joined back.

The result is exactly the unsegmented window's, for ascending orders whose
first column is the numeric time ``t`` used for segmenting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

SEG = "_tk_seg"
ROW = "_tk_row"  # last tie-break of segmented rows: all segments agree on one order
HOT = "_tk_hot"  # only keys at segment ends have more than one segment, so only they need border values
DEFAULT_ROWS_PER_SEGMENT = 4_000_000


def _default(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dt)
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    return F.lit(None).cast(dt)


def norm_keys(keys: Sequence[str]) -> list[str]:
    """Names of the normalised (never NULL) key columns plus their NULL
    flags.  Windows, aggregates and join-backs all use these same columns,
    so the rows are shuffled once and every later step is co-partitioned."""
    return [f"_tk_kv{i}" for i in range(len(keys))] + [f"_tk_kn{i}" for i in range(len(keys))]


def _join_back(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join on never-NULL columns (plain ``=`` keeps the join on
    the same hash partitioning as the window before it)."""
    return df.join(small, list(keys), "left")


def _nulls_last(order: Sequence[str]) -> Column:
    """The order as one comparable value; NULLs sort last, as in the windows."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def _full(df: DataFrame, order: Sequence[str]) -> list[str]:
    return [*order, ROW] if ROW in df.columns else list(order)


def segment(df: DataFrame, keys: Sequence[str], t: Column,
            rows_per_segment: int = DEFAULT_ROWS_PER_SEGMENT, tie_break: Sequence[str] = ()) -> DataFrame:
    """Add ``_tk_t`` (numeric order), ``_tk_seg`` (segment number) and
    ``_tk_hot``.  Without a key of more than ``rows_per_segment`` rows there is
    one segment; otherwise segments are consecutive ranges of (keys, time,
    ``tie_break``, row), NULL times last, of about ``rows_per_segment`` rows."""
    base = df.withColumn("_tk_t", t)
    for i, k in enumerate(keys):
        base = (base.withColumn(f"_tk_kv{i}", F.coalesce(F.col(k), _default(df.schema[k].dataType)))
                    .withColumn(f"_tk_kn{i}", F.col(k).isNull()))
    nk = norm_keys(keys)
    counts = base.groupBy(*nk).agg(F.count(F.lit(1)).alias("_tk_n"))
    # One aggregate job decides: with no hot key the frame gets constant
    # segment 0 and every border fix-up is pruned while planning.
    most, total = counts.agg(F.max("_tk_n"), F.sum("_tk_n")).first()
    if (most or 0) <= rows_per_segment:
        return base.withColumn(SEG, F.lit(0).cast("long")).withColumn(HOT, F.lit(False))
    order = [*[F.col(c).asc() for c in nk], *[F.col(c).asc_nulls_last() for c in ("_tk_t", *tie_break, ROW)]]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_per_segment))
    ranged = (base.withColumn(ROW, F.monotonically_increasing_id()).repartitionByRange(parts, *order)
              .withColumn(SEG, F.spark_partition_id().cast("long")))
    held = materialize(ranged, "segments")
    key = F.struct(*nk)
    ends = (held.groupBy(SEG).agg(F.min(key).alias("a"), F.max(key).alias("b"))   # one row a segment
            .select(F.explode(F.array("a", "b")).alias("k")).select("k.*").distinct().withColumn(HOT, F.lit(True)))
    return _join_back(held, ends, nk).withColumn(HOT, F.coalesce(HOT, F.lit(False)))


def unsegment(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.drop("_tk_t", SEG, HOT, ROW, *norm_keys(keys))


def _w(keys, order):
    return Window.partitionBy(*norm_keys(keys), SEG).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def seg_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """``lag(value)`` over (keys, order) on a segmented frame."""
    order = _full(df, order)
    w = _w(keys, order)
    local = (df.withColumn("_tk_lp", F.lag(value).over(w))
               .withColumn("_tk_first", F.lag(F.lit(1)).over(w).isNull()))
    summary = local.filter(HOT).groupBy(*norm_keys(keys), SEG).agg(
        F.max_by(F.col(value), _nulls_last(order)).alias("_tk_last"))
    across = summary.select(*norm_keys(keys), SEG, F.lag("_tk_last").over(
        Window.partitionBy(*norm_keys(keys)).orderBy(SEG)).alias("_tk_prev_last"))
    joined = _join_back(local, across, norm_keys(keys) + [SEG])
    return (joined.withColumn(out, F.when(F.col("_tk_first"), F.col("_tk_prev_last"))
                                    .otherwise(F.col("_tk_lp")))
                  .drop("_tk_lp", "_tk_first", "_tk_prev_last"))


def seg_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """``lead(value)`` over (keys, order) on a segmented frame."""
    order = _full(df, order)
    w = _w(keys, order)
    local = (df.withColumn("_tk_ln", F.lead(value).over(w))
               .withColumn("_tk_lastrow", F.lead(F.lit(1)).over(w).isNull()))
    summary = local.filter(HOT).groupBy(*norm_keys(keys), SEG).agg(
        F.min_by(F.col(value), _nulls_last(order)).alias("_tk_firstv"))
    across = summary.select(*norm_keys(keys), SEG, F.lead("_tk_firstv").over(
        Window.partitionBy(*norm_keys(keys)).orderBy(SEG)).alias("_tk_next_first"))
    joined = _join_back(local, across, norm_keys(keys) + [SEG])
    return (joined.withColumn(out, F.when(F.col("_tk_lastrow"), F.col("_tk_next_first"))
                                    .otherwise(F.col("_tk_ln")))
                  .drop("_tk_ln", "_tk_lastrow", "_tk_next_first"))


def seg_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    out: str) -> DataFrame:
    """Running ``sum(value)`` (rows up to the current one) per key."""
    w = _w(keys, _full(df, order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_tk_rs", F.sum(value).over(w))
    tot = local.filter(HOT).groupBy(*norm_keys(keys), SEG).agg(F.sum(value).alias("_tk_tot"))
    before = Window.partitionBy(*norm_keys(keys)).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*norm_keys(keys), SEG, F.sum("_tk_tot").over(before).alias("_tk_off"))
    joined = _join_back(local, offs, norm_keys(keys) + [SEG])
    return (joined.withColumn(out, F.coalesce(F.col("_tk_off"), F.lit(0)) + F.col("_tk_rs"))
                  .drop("_tk_rs", "_tk_off"))


def seg_prefix_before(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Aggregates over all *earlier* rows of the key (rows unbounded
    preceding to -1).  ``aggs`` maps an output name to (kind, column) with
    kind in {'max', 'sum', 'count'} (all associative)."""
    w = _w(keys, _full(df, order)).rowsBetween(Window.unboundedPreceding, -1)
    local = df
    seg_aggs = []
    for name, (kind, col) in aggs.items():
        if kind == "max":
            local = local.withColumn(f"_tk_l_{name}", F.max(col).over(w))
            seg_aggs.append(F.max(col).alias(f"_tk_s_{name}"))
        elif kind in ("sum", "count"):
            c = col if kind == "sum" else F.when(col.isNotNull(), 1).otherwise(0)
            local = local.withColumn(f"_tk_l_{name}", F.coalesce(F.sum(c).over(w), F.lit(0)))
            seg_aggs.append(F.sum(c).alias(f"_tk_s_{name}"))
        else:
            raise ValueError(kind)
    summary = local.filter(HOT).groupBy(*norm_keys(keys), SEG).agg(*seg_aggs)
    before = Window.partitionBy(*norm_keys(keys)).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    across = summary.select(*norm_keys(keys), SEG, *[
        (F.max if kind == "max" else F.sum)(f"_tk_s_{name}").over(before).alias(f"_tk_p_{name}")
        for name, (kind, _) in aggs.items()])
    joined = _join_back(local, across, norm_keys(keys) + [SEG])
    for name, (kind, _) in aggs.items():
        lo, pr = F.col(f"_tk_l_{name}"), F.col(f"_tk_p_{name}")
        if kind == "max":
            val = F.greatest(lo, pr)  # greatest skips NULLs
        else:
            val = lo + F.coalesce(pr, F.lit(0))
        joined = joined.withColumn(name, val).drop(f"_tk_l_{name}", f"_tk_p_{name}")
    return joined
