from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def order_cols(cols: Sequence[str | Column] | str | None) -> list[Column]:
    """Order columns; names sort ascending with NULLs last (the SQL
    default the operators follow; Spark's own default is NULLS FIRST)."""
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str],
                 rprefix: str = "_tk_r_", extra: Sequence[str] = ()) -> tuple[DataFrame, Column]:
    """Rename ``cols`` on ``right`` (keeping ``extra``) and return (renamed, null-safe condition)."""
    renamed = right.select(*[F.col(c).alias(rprefix + c) for c in cols], *extra)
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(renamed[rprefix + c])
        cond = e if cond is None else cond & e
    return renamed, cond


def ranked_values(df: DataFrame, group: Sequence[str], measure: str, n: int, rank_col: str,
                  dense: bool) -> DataFrame:
    """``df`` with the rows whose ``measure`` (descending, NULLs last) has RANK
    or DENSE_RANK at most ``n`` in its group.

    Ranks are taken over the distinct (group, measure) values with their row
    counts: partial aggregates, then at most ``n`` values a group (a map-side
    WindowGroupLimit).  Rows meet them in a join that AQE splits, so neither a
    large group nor a flood of ties is gathered in one task."""
    group = list(group)
    vals = df.groupBy(*group, measure).agg(F.count(F.lit(1)).alias("_tk_c"))
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last())
    top = vals.withColumn("_tk_k", F.row_number().over(w)).filter(F.col("_tk_k") <= n)
    if dense:
        top = top.withColumn(rank_col, F.col("_tk_k"))
    else:
        before = F.coalesce(F.sum("_tk_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        top = top.withColumn(rank_col, (before + 1).cast("int")).filter(F.col(rank_col) <= n)
    renamed, cond = null_safe_on(df, top, [*group, measure], extra=[rank_col])
    return df.join(renamed, cond).select(*df.columns, rank_col)
