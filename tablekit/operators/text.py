"""Text cleaning, fuzzy matching and lexicon sentiment (SURVEY §2.3,
T06-T10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ASCII_NON_LETTERS, ASCII_SPACE, best_partial_match, best_token_sort, fold_accents, sort_words, strip_controls
from ..plans.ranking import global_positions
from ..session import materialize
from ._util import as_list
from .similarity import BLOCK_PAIRS, best_references

# fixed value: place-name stop words removed by the cleaner (Portuguese
# administrative words: union, of the, parish(es), municipality)
PLACE_STOP_WORDS = r"(?i)\b(uniao|das|dos|de|da|do|freguesia|freguesias|municipio)\b"


def clean_place_name(c: Column) -> Column:
    """NFKD fold + ASCII only, non-letters to blank, hyphen to blank,
    drop stop words, squeeze blanks, title case, trim.  NULL gives ''."""
    s = fold_accents(c)
    # after folding only ASCII remains: non-letters and '-' become blanks in
    # one translate pass (same result as the character-class regex)
    s = F.translate(s, ASCII_NON_LETTERS + "-", " " * (len(ASCII_NON_LETTERS) + 1))
    s = F.regexp_replace(s, PLACE_STOP_WORDS, "")
    s = F.regexp_replace(s, f"{ASCII_SPACE}+", " ")
    s = F.initcap(F.trim(s))
    return F.coalesce(s, F.lit(""))


def clean_place_names(df: DataFrame, column: str, out_col: str | None = None) -> DataFrame:
    """Add the cleaned name; a non-text column gives '' like NULL does."""
    from pyspark.sql import types as T
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(out_col or f"{column}_clean", F.lit(""))
    return df.withColumn(out_col or f"{column}_clean", clean_place_name(F.col(column)))


def strip_control_chars(df: DataFrame, cols) -> DataFrame:
    """Remove control characters (C0, DEL, C1) and replacement characters
    left by undecodable bytes from text columns, then trim blanks."""
    out = df
    for c in as_list(cols):
        out = out.withColumn(c, strip_controls(F.col(c)))
    return out


def _references(ref: DataFrame, ref_column: str, ref_order: str | None) -> DataFrame:
    """Distinct reference values, numbered (``ord``) in their order."""
    refs = (ref.select(F.col(ref_column).cast("string").alias("ref_key"),
                       F.col(ref_order or ref_column).alias("_tk_o"))
               .filter(F.col("ref_key").isNotNull())
               .groupBy("ref_key").agg(F.min("_tk_o").alias("_tk_o")))
    return global_positions(refs, [F.col("_tk_o"), F.col("ref_key")], pos_col="ord").select("ord", "ref_key")


def _in_blocks(values: DataFrame, refs: DataFrame, chunk_size: int) -> DataFrame:
    """Each value (``key``) with each chunk (``_tk_cands``) of at most
    ``chunk_size`` numbered reference values."""
    chunks = (refs.withColumn("_tk_chunk", F.floor((F.col("ord") - 1) / chunk_size))
                  .groupBy("_tk_chunk")
                  .agg(F.array_sort(F.collect_list(F.struct("ord", F.col("ref_key").alias("value")))).alias("_tk_cands")))
    n_chunks = refs.agg(F.ceil(F.count(F.lit(1)) / chunk_size).cast("long")).scalar()
    fanned = values.withColumn("_tk_chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(n_chunks - 1, F.lit(0)).cast("long"))))
    return fanned.join(chunks, "_tk_chunk").drop("_tk_chunk")


def fuzzy_match(dirty: DataFrame, ref: DataFrame, column: str, ref_column: str,
                cutoff: float = 60.0, chunk_size: int = 2000, ref_order: str | None = None,
                out_col: str = "matched", score_col: str = "score", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Best reference value per distinct dirty value by partial ratio; below
    ``cutoff`` (or empty input) the match is ''.  The match is upper-cased
    with control characters removed.  Ties go to the first reference value
    in ``ref_order`` (default: the value itself).

    Plan: the top-1 similarity join of ``operators.similarity`` brings each
    *distinct* value only the references that may beat what a cheap first
    pass found.  Values that resemble no reference (too little to force a
    shared bigram) are a query set that meets the whole reference in blocks of
    at most ``chunk_size`` values, scored by an Arrow UDF that skips
    candidates whose exact upper bound is too low; so are all values when there
    are no more than ``block_pairs`` pairs."""
    refs = _references(ref, ref_column, ref_order)
    values = dirty.select(F.col(column).cast("string").alias("v")).distinct()
    found, rest = best_references(values.withColumn("key", F.col("v")), refs, partial=True, block_pairs=block_pairs)
    blocks = (_in_blocks(rest, refs, chunk_size).select("v", best_partial_match(F.col("key"), F.col("_tk_cands")).alias("b"))
              .select("v", "b.score", "b.ord").where("score is not null"))
    best = (found.unionByName(blocks).groupBy("v")
            .agg(F.max_by(F.struct("score", "ord"), F.struct("score", -F.col("ord"))).alias("b"))
            .select("v", "b.score", "b.ord").join(refs, "ord", "left"))
    all_values = values.join(best.withColumnRenamed("v", "_tk_v"), F.col("v").eqNullSafe(F.col("_tk_v")), "left")
    match = F.when(F.col("score") >= F.lit(cutoff), F.upper(strip_controls(F.col("ref_key")))).otherwise(F.lit(""))
    return all_values.select(F.col("v").alias(column), match.alias(out_col),
                             F.coalesce(F.col("score"), F.lit(0.0)).alias(score_col))


def match_quality(dirty: DataFrame, ref: DataFrame, column: str, ref_column: str, cutoff: float = 60.0,
                  chunk_size: int = 2000, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Quality of a fuzzy match over all distinct values: the average and the
    maximum of each value's best token-sort ratio to the reference, and how
    many values found and did not find a match at ``cutoff``.  Empty values
    count as unmatched with ratio 0.  Values meet the reference as in
    ``fuzzy_match``, by their words in sorted order."""
    refs = _references(ref.select(sort_words(F.col(ref_column).cast("string")).alias("_tk_r")), "_tk_r", None)
    values = dirty.select(F.col(column).cast("string").alias("v")).distinct()
    keys = values.select(F.coalesce(sort_words("v"), F.lit("")).alias("key")).distinct().select(F.col("key").alias("v"), "key")
    found, rest = best_references(keys, refs, partial=False, block_pairs=block_pairs)
    blocks = (_in_blocks(rest, refs, chunk_size).select("v", best_token_sort(F.col("key"), F.col("_tk_cands")).alias("score"))
              .groupBy("v").agg(F.max("score").alias("score")))
    best = found.select("v", "score").unionByName(blocks).withColumnRenamed("v", "_tk_key")
    scored = (values.withColumn("key", F.coalesce(sort_words("v"), F.lit("")))
              .join(best, F.col("key") == F.col("_tk_key"), "left").select(F.coalesce("score", F.lit(0.0)).alias("_tk_q")))
    scores = scored.agg(F.avg("_tk_q").alias("avg_score"), F.max("_tk_q").alias("max_score"))
    hits = fuzzy_match(dirty, ref, column, ref_column, cutoff, chunk_size, block_pairs=block_pairs).agg(
        F.count_if(F.col("matched") != "").alias("matched_count"),
        F.count_if(F.col("matched") == "").alias("unmatched_count"))
    # one row each
    return scores.crossJoin(hits)


BROADCAST_WORDS = 300_000   # a lexicon of at most so many words goes to every task whole (some tens of MB)
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"  # fixed values: labels


def sentiment_label(df: DataFrame, text: str, lexicon: DataFrame,
                    word_col: str = "word", score_col: str = "polarity",
                    pos_threshold: float = 0.1, neg_threshold: float = -0.1) -> DataFrame:
    """Polarity per text = mean lexicon score of its tokens found in the
    lexicon (0 when none), labelled positive (> 0.1), negative (< -0.1) or
    neutral.  Tokens are lower-case [a-z]+ runs of the whole text; a word
    listed twice in the lexicon scores its mean.

    The score depends on the text alone, so texts are keyed by a 128-bit hash
    of themselves: repeated or missing ids cannot mix rows.  A lexicon of at
    most ``BROADCAST_WORDS`` words is broadcast, so a text's words are averaged
    where they are and one row per text is shuffled.  With a larger one, (text,
    word) counts are aggregated map-side, joined to it (AQE picks the strategy
    and splits skew) and averaged with the counts as weights.  Either is joined
    back on the hash."""
    lex = materialize(lexicon.groupBy(F.col(word_col).alias("_tk_w"))
                             .agg(F.avg(F.col(score_col).cast("double")).alias("_tk_s")), "lexicon")
    key = {"_tk_k1": F.xxhash64(F.col(text)), "_tk_k2": F.xxhash64(F.lit(1), F.col(text))}
    tokens = F.split(F.lower(F.col(text)), "[^a-z]+")
    words = (df.select(*[c.alias(k) for k, c in key.items()], F.explode(tokens).alias("_tk_w"))
               .filter(F.col("_tk_w") != ""))
    if lex.count() <= BROADCAST_WORDS:
        counted = words.withColumn("_tk_n", F.lit(1)).join(F.broadcast(lex), "_tk_w")
    else:
        counted = words.groupBy(*key, "_tk_w").agg(F.count(F.lit(1)).alias("_tk_n")).join(lex, "_tk_w")
    scores = (counted.groupBy(*key)
                    .agg((F.sum(F.col("_tk_s") * F.col("_tk_n")) / F.sum("_tk_n")).alias("_tk_p")))
    scored = df.withColumns(key).join(scores, list(key), "left")
    pol = F.coalesce(F.col("_tk_p"), F.lit(0.0))
    label = (F.when(pol > pos_threshold, POSITIVE).when(pol < neg_threshold, NEGATIVE)
              .otherwise(NEUTRAL))
    return (scored.withColumn("polarity", F.round(pol, 6)).withColumn("sentiment", label)
                  .drop("_tk_p", *key))
