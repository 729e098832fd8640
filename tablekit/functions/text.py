"""Text helpers.  Regex work stays in JVM built-ins; the only Python is two
small Arrow-batched pandas UDFs: NFKD accent folding (Spark has no Unicode
normalisation function) and the partial-ratio scorer."""

from __future__ import annotations

import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: control characters removed from text (C0, DEL, C1) and the
# Unicode replacement character left by undecodable bytes
CONTROL_CHARS = "[\\x00-\\x1F\\x7F-\\x9F]"
REPLACEMENT_CHAR = "�"

# fixed value: whitespace as Python's str regex \s sees it in ASCII text
ASCII_SPACE = "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F ]"


try:  # Arrow-native UDF (PySpark >= 4.1): vectorised C++ kernels, no pandas copy
    import pyarrow as pa
    import pyarrow.compute as pc

    @F.arrow_udf(T.StringType())
    def fold_accents(s: pa.Array) -> pa.Array:
        """NFKD decomposition, then drop every non-ASCII code point."""
        return pc.replace_substring_regex(pc.utf8_normalize(s, "NFKD"), "[^\\x00-\\x7F]", "")
except (AttributeError, ImportError):  # older PySpark: pandas UDF
    @F.pandas_udf(T.StringType())
    def fold_accents(s: pd.Series) -> pd.Series:
        """NFKD decomposition, then drop every non-ASCII code point."""
        return s.map(lambda v: None if v is None else
                     unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii"))


# ASCII characters other than letters, hyphen and whitespace: after folding
# to ASCII these are the only ones the cleaner turns into blanks, so a
# single-pass ``translate`` replaces the character-class regex.
ASCII_NON_LETTERS = "".join(chr(i) for i in range(0x20, 0x7F)
                            if not chr(i).isalpha() and chr(i) not in " -") + "\x00\x01\x02\x03\x04\x05\x06\x07\x08\x0e\x0f\x10\x11\x12\x13\x14\x15\x16\x17\x18\x19\x1a\x1b\x7f"


def strip_controls(c: Column) -> Column:
    out = F.regexp_replace(c, CONTROL_CHARS, "")
    out = F.regexp_replace(out, REPLACEMENT_CHAR, "")
    return F.trim(out)


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel (one big-int
    step per character of ``b``)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def indel_ratio(a: str, b: str) -> float:
    """Normalised Indel similarity 0-100: 2*LCS / (len a + len b)."""
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    return 200.0 * lcs_length(a, b) / total


def partial_ratio(a: str, b: str) -> float:
    """Best Indel similarity of the shorter string with any window of the
    longer one: windows of its length, and the shorter ones at both ends."""
    if not a or not b:
        return 0.0
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    m, n = len(short), len(long_)
    windows = [long_[i:i + m] for i in range(n - m + 1)]
    windows += [w for k in range(1, m) for w in (long_[:k], long_[n - k:])]
    best = 0.0
    for w in windows:
        if 200.0 * min(m, len(w)) / (m + len(w)) <= best:  # even a full match is no better
            continue
        best = max(best, indel_ratio(short, w))
        if best == 100.0:
            break
    return best


def sorted_words(s: str | None) -> str:
    return " ".join(sorted((s or "").split()))


@F.pandas_udf(T.StringType())
def sort_words(s: pd.Series) -> pd.Series:
    """The words of each text in sorted order; NULL stays."""
    return s.map(lambda v: None if v is None else sorted_words(v))


def token_sort_ratio(a: str, b: str) -> float:
    """Indel similarity of the words of both strings in sorted order."""
    x, y = sorted_words(a), sorted_words(b)
    return indel_ratio(x, y) if x and y else 0.0


@F.pandas_udf(T.DoubleType())
def best_token_sort(values: pd.Series, candidates: pd.Series) -> pd.Series:
    """For each value, the highest token-sort ratio to any candidate (0 without)."""
    counts: dict = {}
    out = []
    for v, cands in zip(values, candidates):
        x = sorted_words(v)
        best = 0.0
        for c in cands if x and cands is not None else ():
            y = sorted_words(c["value"])
            if not y:
                continue
            cx = counts.get(x) or counts.setdefault(x, Counter(x))
            cy = counts.get(y) or counts.setdefault(y, Counter(y))
            if 200.0 * sum(min(n, cy.get(ch, 0)) for ch, n in cx.items()) / (len(x) + len(y)) > best:
                best = max(best, indel_ratio(x, y))
        out.append(best)
    return pd.Series(out, dtype="float64")


BEST_MATCH = T.StructType([T.StructField("match", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("ord", T.LongType())])


def ratio_upper_bound(a: str, b: str, counts: dict) -> float:
    """An upper bound of ``partial_ratio(a, b)``: the LCS of the shorter
    string with any window is at most the size k of the multiset intersection
    of their characters, and the shortest window that holds k is k long."""
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0.0
    cs = counts.get(short) or counts.setdefault(short, Counter(short))
    cl = counts.get(long_) or counts.setdefault(long_, Counter(long_))
    overlap = sum(min(n, cl.get(ch, 0)) for ch, n in cs.items())
    return 200.0 * overlap / (len(short) + overlap)


@F.pandas_udf(BEST_MATCH)
def best_partial_match(values: pd.Series, candidates: pd.Series) -> pd.DataFrame:
    """For each value, the candidate (struct ord, value; sorted by ord) with
    the highest partial ratio; ties keep the smallest ``ord``.  Exact branch and bound:
    a candidate whose upper bound cannot beat the best so far is not scored
    (every candidate is still considered)."""
    out_m, out_s, out_o = [], [], []
    counts: dict = {}
    for v, cands in zip(values, candidates):
        best_m, best_s, best_o = None, -1.0, None
        if v and cands is not None:
            for c in cands:
                cv = c["value"] or ""
                if best_o is not None and (best_s >= 100.0 or ratio_upper_bound(v, cv, counts) <= best_s):
                    continue
                s = partial_ratio(v, cv)
                if s > best_s:
                    best_m, best_s, best_o = cv, s, c["ord"]
        out_m.append(best_m)
        out_s.append(best_s if best_o is not None else None)
        out_o.append(best_o)
    return pd.DataFrame({"match": out_m, "score": out_s, "ord": out_o})
