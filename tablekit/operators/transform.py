"""Row transforms."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import key_uuid, sha256_of
from ..plans.ranking import global_positions
from ._util import as_list, order_cols


def add_row_id_and_hash(df: DataFrame, hash_cols: Sequence[str], key_cols: Sequence[str] | None = None,
                        id_col: str = "uuid", hash_col: str = "hash_data",
                        mode: str = "null_marked", id_mode: str = "key") -> DataFrame:
    """Add a row id and a SHA-256 of ``hash_cols``; a column already present
    is kept as it is.  ``id_mode='key'`` derives a stable UUID-shaped id from
    ``key_cols`` (default ``hash_cols``); ``'uuid'`` draws a random one that
    changes on every recomputation (write it before reuse)."""
    missing = [c for c in hash_cols if c not in df.columns]
    if missing:
        raise ValueError(f"hash columns not found: {missing}")
    out = df
    if id_col not in df.columns:
        if id_mode == "key":
            out = out.withColumn(id_col, key_uuid(list(key_cols or hash_cols), mode))
        elif id_mode == "uuid":
            out = out.withColumn(id_col, F.expr("uuid()"))
        else:
            raise ValueError("id_mode must be 'key' or 'uuid'")
    if hash_col not in df.columns:
        out = out.withColumn(hash_col, sha256_of(list(hash_cols), mode))
    return out


def standard_names(names: Sequence[str]) -> list[str]:
    """strip, lower, blanks to underscore; collisions get _2, _3, ..."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        base = re.sub(r"\s+", "_", n.strip().lower())
        name = base
        while name in seen:
            seen[base] += 1
            name = f"{base}_{seen[base]}"
        seen.setdefault(name, 1)
        out.append(name)
    return out


def standardize_table(df: DataFrame, drop_duplicates: bool = True) -> DataFrame:
    """Trim, lower-case and underscore column names; drop duplicate rows."""
    out = df.toDF(*standard_names(df.columns))
    return out.dropDuplicates() if drop_duplicates else out


def normalize_by_max(df: DataFrame, column: str, out_col: str | None = None) -> DataFrame:
    """``column / max(column)``; NULL when the maximum is 0.  The maximum is a
    scalar subquery (one partial aggregate), not a cross join."""
    mx = df.agg(F.max(column)).scalar()
    return df.withColumn(out_col or f"{column}_normalized",
                         F.try_divide(F.col(column).cast("double"), mx.cast("double")))


def drop_sensitive_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The table without the listed columns (absent ones ignored)."""
    return df.drop(*as_list(cols))


def global_order(df: DataFrame, order: Sequence[str | Column], limit: int | None = None,
                 pos_col: str = "position", num_partitions: int | None = None) -> DataFrame:
    """Rows in global order with a 1-based position.  Without ``limit`` the
    positions come from range partitioning plus per-partition offsets (no
    single-task window); with ``limit`` it is a top-k (TakeOrderedAndProject)
    and numbering runs over the k rows only.  ``order`` should be unique."""
    cols = order_cols(order)
    if limit is not None:
        top = df.orderBy(*cols).limit(int(limit))
        return top.withColumn(pos_col, F.row_number().over(Window.orderBy(*cols)).cast("long"))
    return global_positions(df, cols, pos_col=pos_col, num_partitions=num_partitions)
