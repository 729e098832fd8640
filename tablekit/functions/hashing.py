"""Row hashing expressions (JVM built-ins only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"  # fixed value: separator of the hashed text


def joined_text(cols: Sequence[str], mode: str = "null_marked") -> Column:
    """Text form of several columns.  ``compat``: ``concat_ws('||')``, which
    silently drops NULLs (('a',NULL,'b') == ('a','b')).  ``null_marked``: a
    JSON array of the string values, NULLs kept, unambiguous."""
    as_text = [F.col(c).cast("string") for c in cols]
    if mode == "compat":
        return F.concat_ws(SEPARATOR, *as_text)
    if mode == "null_marked":
        return F.to_json(F.array(*as_text))
    raise ValueError("mode must be 'compat' or 'null_marked'")


def sha256_of(cols: Sequence[str], mode: str = "null_marked") -> Column:
    return F.sha2(joined_text(cols, mode), 256)


def key_uuid(cols: Sequence[str], mode: str = "null_marked") -> Column:
    """A stable UUID-shaped id from key columns (md5 of their text), equal
    on every recomputation, unlike ``uuid()``."""
    h = F.md5(joined_text(cols, mode))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
