"""Slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_micros
from ..plans.ranking import global_positions
from ..plans.segments import DEFAULT_ROWS_PER_SEGMENT, seg_lag, seg_lead, seg_prefix_before, segment, unsegment
from ._util import as_list, order_cols

OPEN_END = "9999-12-31"  # fixed value: open end of a validity interval


def scd2_intervals(df: DataFrame, key: str | Sequence[str], attrs: str | Sequence[str], ts: str,
                   open_end: str = OPEN_END, tie_break: Sequence[str] = (),
                   collapse: bool = False, from_col: str = "valid_from",
                   to_col: str = "valid_to",
                   rows_per_segment: int = DEFAULT_ROWS_PER_SEGMENT) -> DataFrame:
    """Change log -> validity intervals.  ``valid_to`` is the next change of
    the same key (touching intervals), ``open_end`` for the last one.  Equal
    consecutive values are kept unless ``collapse=True``.  Keys with more
    than ``rows_per_segment`` changes are split into time segments
    (plans.segments): exact, and no task holds a hot key whole."""
    keys, attrs = as_list(key), as_list(attrs)
    extra = [c for c in as_list(tie_break) if c not in keys + attrs + [ts]]
    order = ["_tk_t", *as_list(tie_break)]
    src = segment(df.select(*keys, *attrs, ts, *extra), keys, epoch_micros(df, ts), rows_per_segment, as_list(tie_break))
    if collapse:
        src = seg_lag(src.withColumn("_tk_a", F.struct(*attrs)), keys, order, "_tk_a", "_tk_pa")
        same = None
        for a in attrs:
            e = F.col(a).eqNullSafe(F.col(f"_tk_pa.{a}"))
            same = e if same is None else same & e
        src = src.filter(~(F.col("_tk_pa").isNotNull() & same)).drop("_tk_a", "_tk_pa")
    ts_type = df.schema[ts].dataType.simpleString()
    nxt = seg_lead(src, keys, order, ts, "_tk_next")
    return nxt.select(*keys, *attrs, *extra, F.col(ts).alias(from_col),
                      F.coalesce(F.col("_tk_next"), F.lit(open_end).cast(ts_type)).alias(to_col))


def scd2_overlaps(df: DataFrame, keys: str | Sequence[str], start: str, end: str,
                  mode: str = "adjacent", tie_break: Sequence[str] = (),
                  rows_per_segment: int = DEFAULT_ROWS_PER_SEGMENT) -> DataFrame:
    """Dimension rows whose interval starts before an earlier interval of the
    same key ends (NULL end = open = infinity).  ``adjacent`` compares with
    the previous row only; ``any`` with the running maximum of all earlier
    ends.  A start equal to the previous end is fine.  Adds ``prev_end``.
    Hot keys are split into segments (plans.segments)."""
    keys = as_list(keys)
    order = ["_tk_t", *as_list(tie_break)]
    seg = segment(df, keys, epoch_micros(df, start), rows_per_segment, as_list(tie_break))
    if mode == "adjacent":
        lagged = seg_lag(seg.withColumn("_tk_e", F.struct(F.col(end).alias("e"))), keys, order,
                         "_tk_e", "_tk_pe")
        prev_end = F.col("_tk_pe.e")
        bad = F.col("_tk_pe").isNotNull() & (prev_end.isNull() | (F.col(start) < prev_end))
        out = lagged.withColumn("prev_end", prev_end).filter(bad)
        return unsegment(out.drop("_tk_e", "_tk_pe"), keys)
    if mode == "any":
        pre = seg_prefix_before(seg, keys, order, {
            "_tk_nb": ("count", F.lit(1)),
            "_tk_open": ("sum", F.when(F.col(end).isNull(), 1).otherwise(0)),
            "prev_end": ("max", F.col(end))})
        bad = (F.col("_tk_nb") > 0) & ((F.col("_tk_open") > 0) | (F.col(start) < F.col("prev_end")))
        return unsegment(pre.filter(bad).drop("_tk_nb", "_tk_open"), keys)
    raise ValueError("mode must be 'adjacent' or 'any'")


def scd2_single_current(df: DataFrame, keys: str | Sequence[str],
                        flag: str = "Flg_Is_Current") -> DataFrame:
    """Natural keys whose number of current rows is not exactly 1 (NULL flag
    counts as not current).  A partially aggregated groupBy."""
    keys = as_list(keys)
    return (df.groupBy(*keys)
              .agg(F.sum(F.when(F.col(flag), 1).otherwise(0)).alias("current_count"))
              .filter(F.col("current_count") != 1))


def scd2_merge(new: DataFrame, current: DataFrame, keys: str | Sequence[str],
               attrs: str | Sequence[str] | None = None, sk: str = "SurrogateKey",
               start: str = "Start_Date", end: str = "End_Date", flag: str = "Flg_Is_Current",
               now: str | Column | None = None, tie_break: Sequence[str] = (),
               num_partitions: int | None = None) -> DataFrame:
    """Type-2 merge of an incoming snapshot into a dimension.

    Incoming rows (deduplicated per key by ``tie_break``) are NEW when no
    current row matches, CHANGED when an attribute differs (null-safe), else
    UNCHANGED.  All current rows of a CHANGED key (also where a damaged dimension
    has several) are expired (``end`` = now, flag false);
    NEW and CHANGED rows are appended as current versions with surrogate keys
    max(sk) + 1.. in key order (distributed positions, not one task).  History
    rows and keys absent from the input pass through.  ``now`` is one value
    for the whole run."""
    keys = as_list(keys)
    now_col = F.current_timestamp().cast("timestamp_ntz") if now is None else (
        now if isinstance(now, Column) else F.lit(now))
    ts_type = current.schema[start].dataType.simpleString()
    now_col = now_col.cast(ts_type)
    reserved = set(keys) | {sk, start, end, flag}
    cand = [c for c in (as_list(attrs) if attrs is not None else new.columns) if c not in reserved]
    attrs = [c for c in cand if c in current.columns and c in new.columns]
    if not attrs:
        raise ValueError("no attribute present on both sides to compare")

    w = Window.partitionBy(*keys).orderBy(*(order_cols(tie_break) or [F.col(k) for k in keys]))
    incoming = (new.select(*keys, *attrs, *[c for c in as_list(tie_break) if c not in keys + attrs])
                   .withColumn("_tk_rn", F.row_number().over(w)).filter("_tk_rn = 1")
                   .select(*keys, *attrs))
    is_current = F.coalesce(F.col(flag), F.lit(False))
    active = current.filter(is_current)
    history = current.filter(~is_current)

    cur = active.select(*keys, *[F.col(a).alias("_tk_c_" + a) for a in attrs], F.lit(1).alias("_tk_hit"))
    joined = incoming.join(cur, keys, "left")
    differs = reduce(Column.__or__, [~F.col(a).eqNullSafe(F.col("_tk_c_" + a)) for a in attrs])
    status = (F.when(F.col("_tk_hit").isNull(), "NEW")
               .when(differs, "CHANGED").otherwise("UNCHANGED"))
    # a key with several current rows is one incoming row: CHANGED when any of them differs
    once = (joined.withColumn("_tk_status", status).groupBy(*keys)
            .agg(F.min("_tk_status").alias("_tk_status"), F.any_value(F.struct(*attrs)).alias("_tk_a")))
    # used three times below (changed keys twice, new versions): written
    # once as Parquet in the shared folder instead of re-running the join
    from ..session import materialize
    classified = materialize(once.select(*keys, "_tk_a.*", "_tk_status"), "scd2_classified")
    changed_keys = classified.filter(F.col("_tk_status") == "CHANGED").select(*keys)

    expired = (active.join(changed_keys, keys, "left_semi")
                     .withColumn(end, now_col).withColumn(flag, F.lit(False)))
    kept_active = active.join(changed_keys, keys, "left_anti")

    versions = classified.filter(F.col("_tk_status").isin("NEW", "CHANGED")).select(*keys, *attrs)
    max_sk = current.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()
    positioned = global_positions(versions, [F.col(k) for k in keys], pos_col="_tk_pos",
                                  num_partitions=num_partitions)
    fresh = (positioned.withColumn(sk, (max_sk + F.col("_tk_pos")).cast(current.schema[sk].dataType))
                       .withColumn(start, now_col)
                       .withColumn(end, F.lit(None).cast(ts_type))
                       .withColumn(flag, F.lit(True)))
    cols = current.columns
    return (history.select(*cols)
            .unionByName(kept_active.select(*cols))
            .unionByName(expired.select(*cols))
            .unionByName(fresh.select(*[c for c in cols if c in fresh.columns]),
                         allowMissingColumns=True))
