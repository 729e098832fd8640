"""Top-1 similarity joins: the best reference value for every value, without
meeting all pairs.

A score of at least r between two strings forces common q-grams.  Let s be the
string whose c characters are matched (the shorter one for a partial ratio,
either one for a full ratio): 2c / (2c + e) >= r bounds the e unmatched
characters of both, the matched ones form at most e + 1 runs that are
contiguous in both strings, and a run of k characters holds k - q + 1 grams.
So at least T = min over c of c - (q - 1)(e + 1) grams are shared, and the
other string holds one of any G - T + 1 of the G grams of s: an inverted index
is probed with the rarest ones only.

1. A cheap first pass scores a few references that share a value's rarest
   grams: a lower bound of its best score.
2. The bound sets T per value, and the prefix probes of the index bring every
   reference that may still reach it.  For partial ratios references shorter
   than the value are found the other way round, by their own prefixes, one
   index per band of bounds.
3. Candidates whose multiset bound beats the lower bound are scored.

Values whose bound is too low to force a shared bigram (no reference is like
them) are left to the caller, who meets them with the reference in blocks.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import indel_ratio, partial_ratio, ratio_upper_bound
from ..session import materialize

BANDS = (100, 95, 90, 85, 80, 75, 70)   # a bound counts as the highest of these that it reaches
PROBES, PROBE_POSTINGS, FIRST = 8, 500, 8   # first pass: grams probed, longest posting list, references scored
GRAM_SIZES = (3, 2, 1)
BLOCK_PAIRS = 1_000_000   # no more pairs than these are scored in blocks at once: the same answer in fewer jobs


@lru_cache(maxsize=1 << 16)
def shared_grams(q: int, m: int, band: int, partial: bool) -> int:
    """The fewest q-grams that a string of ``m`` characters shares with any
    other at a score of at least ``band`` (0: none are forced)."""
    r = band / 100
    least = None
    for c in range(max(1, math.ceil(m * r / (2 - r) - 1e-9)), m + 1):
        e = math.floor(2 * c * (1 - r) / r + 1e-9)
        if m - c > e:
            continue
        if partial:  # the window is no longer than the string
            e = min(e, 2 * (m - c))
        t = c - (q - 1) * (e + 1)
        least = t if least is None else min(least, t)
    return max(0, least or 0)


def probe_plan(m: int, band: int, partial: bool, sizes=GRAM_SIZES) -> tuple[int, int] | None:
    """(gram size, how many grams to probe) for the largest size that works."""
    for q in sizes:
        if m >= q and (t := shared_grams(q, m, band, partial)) >= 1:
            return q, m - q + 1 - t + 1
    return None


GRAMS = T.ArrayType(T.StructType([T.StructField("q", T.IntegerType()), T.StructField("gram", T.StringType())]))


@F.pandas_udf(GRAMS)
def grams(texts: pd.Series) -> pd.Series:
    """All q-grams, each with its occurrence number, so that shared entries count as in multisets."""
    out = []
    for s in texts:
        seen: Counter = Counter()
        rows = []
        for q in GRAM_SIZES:
            for i in range(len(s or "") - q + 1):
                g = s[i:i + q]
                seen[g] += 1
                rows.append({"q": q, "gram": f"{seen[g]}:{g}"})
        out.append(rows)
    return pd.Series(out, dtype=object)


def _plan_udf(partial: bool, sizes):
    @F.pandas_udf("struct<q:int,keep:int>")
    def plan(m: pd.Series, band: pd.Series) -> pd.DataFrame:
        got = [probe_plan(int(a), int(b), partial, sizes) if b > 0 else None for a, b in zip(m, band.fillna(0))]
        return pd.DataFrame([g or (0, 0) for g in got], columns=["q", "keep"]).astype("int32")

    return plan


def _score_udf(partial: bool):
    @F.pandas_udf(T.DoubleType())
    def score(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
        counts: dict = {}
        out = []
        for x, y, bound in zip(a, b, least):
            if len(counts) > 50_000:
                counts.clear()
            if partial:
                out.append(partial_ratio(x, y) if ratio_upper_bound(x, y, counts) >= bound - 1e-9 else None)
            else:
                cx = counts.get(x) or counts.setdefault(x, Counter(x))
                cy = counts.get(y) or counts.setdefault(y, Counter(y))
                most = 200.0 * sum(min(n, cy.get(ch, 0)) for ch, n in cx.items()) / (len(x) + len(y))
                out.append(indel_ratio(x, y) if most >= bound - 1e-9 else None)
        return pd.Series(out, dtype="float64")

    return score


def _rarest(tokens: DataFrame, by: list[str]) -> DataFrame:
    """``tokens`` (with gram, keep, df) less all but the ``keep`` rarest of each ``by``."""
    w = Window.partitionBy(*by).orderBy("df", "gram")
    return tokens.withColumn("_tk_rank", F.row_number().over(w)).where(F.col("_tk_rank") <= F.col("keep")).drop("_tk_rank")


def first_bounds(values: DataFrame, tokens: DataFrame, postings: DataFrame, freq: DataFrame, refs: DataFrame,
                 partial: bool) -> DataFrame:
    """(v, key, m, bound, ord): the best of a few references for each value that shares a gram with any."""
    probes = (tokens.where(F.col("q") > 1).join(freq, "gram").where(F.col("df") <= PROBE_POSTINGS)
              .withColumn("keep", F.lit(PROBES)))
    met = (_rarest(probes, ["v"]).join(postings, "gram").groupBy("v", "ord").agg(F.count(F.lit(1)).alias("n")))
    few = (met.withColumn("_tk_k", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("n"), "ord")))
           .where(F.col("_tk_k") <= FIRST))
    scored = (few.join(values, "v").join(refs, "ord")
              .select("v", "key", "ord", _score_udf(partial)("key", "ref_key", F.lit(0.0)).alias("score")))
    return (scored.groupBy("v", "key").agg(F.max_by(F.struct("score", "ord"), F.struct("score", -F.col("ord"))).alias("b"))
            .select("v", "key", F.length("key").alias("m"), F.col("b.score").alias("bound"), F.col("b.ord").alias("ord")))


def candidates(strong: DataFrame, tokens: DataFrame, postings: DataFrame, freq: DataFrame, refs: DataFrame,
               partial: bool) -> DataFrame:
    """Distinct (v, ord): every reference that may reach its value's bound."""
    probe = (tokens.join(strong.select("v", "m", "q", "keep", "band"), ["v", "q"]).join(freq, "gram", "left")
             .withColumn("df", F.coalesce("df", F.lit(0))))
    met = _rarest(probe, ["v"]).join(postings, "gram")
    if not partial:  # 2c >= r (m + l) with c <= min(m, l)
        r = F.col("band") / 100
        fit = (F.col("l") >= F.col("m") * r / (2 - r) - 1e-6) & (F.col("l") <= F.col("m") * (2 - r) / r + 1e-6)
        return met.where(fit).select("v", "ord").distinct()
    longer = met.where(F.col("l") >= F.col("m")).select("v", "ord")
    used = [x[0] for x in strong.select("band").distinct().collect()]  # at most len(BANDS)
    held = (refs.where("l > 0").withColumn("band", F.explode(F.array(*[F.lit(b) for b in used]) if used else F.array().cast("array<int>")))
            .withColumn("p", _plan_udf(True, GRAM_SIZES)("l", "band"))
            .select("ord", "l", "band", "p.*", F.explode(grams("ref_key")).alias("g"))
            .where(F.col("g.q") == F.col("q")).select("ord", "l", "band", "keep", F.col("g.gram").alias("gram")))
    held = _rarest(held.join(freq, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0))), ["ord", "band"])
    shorter = (tokens.join(strong.select("v", "m", "band"), "v")
               .join(held.select("ord", "l", "band", "gram"), ["band", "gram"])
               .where(F.col("l") < F.col("m")).select("v", "ord"))
    return longer.unionByName(shorter).distinct()


def best_references(values: DataFrame, refs: DataFrame, partial: bool,
                    block_pairs: int = BLOCK_PAIRS) -> tuple[DataFrame, DataFrame]:
    """``values`` (v, key) are distinct, ``refs`` (ord, ref_key) numbered.  Two
    frames: (v, score, ord) of the best reference, the first of equals, for each
    value with a forced gram; and the (v, key) left over."""
    values = values.where(F.length("key") > 0).select("v", "key")
    if values.count() * refs.count() <= block_pairs:
        return values.where(F.lit(False)).select("v", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("ord")), values
    values = materialize(values, "values")
    refs = refs.withColumn("l", F.length("ref_key"))
    tokens = materialize(values.select("v", F.explode(grams("key")).alias("g")).select("v", "g.*"), "grams")
    postings = materialize(refs.select("ord", "l", F.explode(grams("ref_key")).alias("g"))
                           .where("g.q > 1").select("ord", "l", F.col("g.gram").alias("gram")), "postings")
    freq = materialize(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "gram-counts")
    bounds = first_bounds(values, tokens, postings, freq, refs, partial)
    band = F.coalesce(*[F.when(F.col("bound") >= b, F.lit(b)) for b in BANDS])
    strong = materialize(bounds.withColumn("band", band).where("band is not null")
                         .withColumn("p", _plan_udf(partial, GRAM_SIZES[:2])("m", "band")).where("p.q > 0")
                         .select("v", "key", "m", "bound", "ord", "band", "p.*"), "bounds")
    found = (candidates(strong, tokens, postings, freq, refs, partial)
             .join(strong.select("v", "key", "bound"), "v").join(refs.select("ord", "ref_key"), "ord")
             .select("v", "ord", _score_udf(partial)("key", "ref_key", "bound").alias("score")))
    best = (found.where("score is not null").unionByName(strong.select("v", "ord", F.col("bound").alias("score")))
            .groupBy("v").agg(F.max_by(F.struct("score", "ord"), F.struct("score", -F.col("ord"))).alias("b")))
    return best.select("v", "b.score", "b.ord"), values.join(strong.select("v"), "v", "left_anti")
