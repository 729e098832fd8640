"""URL filters: a blocked Bloom filter of the listed canonical keys passes
possible hits to an exact hash join.

A listed key is a host with its subdomains and a path prefix (``net/``,
``example.net/en/``), or a whole canonical URL.  A URL asks for every key
that could cover it: each dot suffix of its host with each path prefix of a
listed length.  Keys absent from the Bloom filter are dropped before any
join; the rest meet the list in an exact join, so false positives never
reach a verdict.  The longest rule that fits wins.

The Bloom filter has blocks of 64 bits (one word per key, ``BITS`` bits set),
built by Spark with ``bit_or``.  Tasks hold it as one array, the value of a
scalar subquery, only while the list has at most ``max_bloom_keys`` keys (its
size is then bounded: 16 bits a key); longer lists keep the filter as a table
that is joined by block.

Defined results: a null URL, or one without ``://``, has empty host and
path; empty hosts meet no rule; repeated URLs are judged alike; an empty list
or table works; extra columns of the pages pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import ascii_lower, col, fresh

BITS = 4
BITS_PER_KEY = 16
MAX_BLOOM_KEYS = 1_000_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """host + path without ``www.``/``m.``, query, fragment, ``.html`` and last slash."""
    host = F.regexp_replace(url_host(url), r"^(www|m)\.", "")
    path = F.regexp_replace(url_path(url), r"(\.html|/)$", "")
    return F.concat(host, path)


def _block(key: Column, blocks: int | Column) -> Column:
    n = F.lit(blocks) if isinstance(blocks, int) else blocks
    return F.pmod(F.xxhash64(key), n).cast("int")


def _mask(key: Column) -> Column:
    h = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, bit))
    return mask


def blocked_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, word): the filter's non-empty 64-bit blocks."""
    return (keys.where(F.col(key).isNotNull())
            .groupBy(_block(F.col(key), blocks).alias("block"))
            .agg(F.bit_or(_mask(F.col(key))).alias("word")))


def possible_hits(rows: DataFrame, key: str, listed: DataFrame, listed_key: str,
                  max_bloom_keys: int = MAX_BLOOM_KEYS) -> DataFrame:
    """The rows whose ``key`` may be listed (no listed key is ever lost)."""
    n = listed.agg(F.approx_count_distinct(listed_key).alias("n")).first()["n"]
    blocks = max(1, n * BITS_PER_KEY // 64)
    bloom = blocked_bloom(listed, listed_key, blocks)
    mask, (word, block) = _mask(col(key)), fresh(rows, "word", "block")
    if n <= max_bloom_keys:
        # one row whose size is bounded by max_bloom_keys * BITS_PER_KEY bits
        every = rows.sparkSession.range(blocks).join(bloom, F.col("id") == F.col("block"), "left")
        packed = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")))).alias("w"))
        table = packed.select(F.col("w")["word"]).scalar()
        held = rows.withColumn(word, F.get(table, _block(col(key), blocks)))
    else:
        named = bloom.select(F.col("block").alias(block), F.col("word").alias(word))
        held = rows.join(named, _block(col(key), blocks) == F.col(block)).drop(block)
    return held.where(F.col(word).bitwiseAND(mask) == mask).drop(word)


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url",
               names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict")) -> DataFrame:
    """``pages`` plus host, path, rule and verdict.

    ``rules``: (rule_host, rule_path, verdict).  ``listed``: one column
    ``canonical`` of blocked canonical URLs, which decides URLs without a
    rule.  All keys of both lists share one Bloom filter."""
    uid, key, canon, verdict, rule, rank = fresh(pages, "url", "key", "canon", "verdict", "rule", "rank")
    host, path = fresh(pages, "host", "path")
    urls = (pages.select(col(url).alias(uid)).distinct()
            .withColumn(host, url_host(F.col(uid))).withColumn(path, url_path(F.col(uid)))
            .withColumn(canon, canonical_url(F.col(uid))))
    keyed = (rules.select(F.concat(F.lit("r:"), "rule_host", F.lit("|"), "rule_path").alias("k"),
                          F.concat("rule_host", "rule_path").alias(rule),
                          F.col("verdict").alias(verdict), F.lit(0).alias(rank),
                          F.struct(F.length(F.concat("rule_host", "rule_path")), F.length("rule_path"), F.concat("rule_host", "rule_path")).alias("size"))
             .unionByName(listed.select(F.concat(F.lit("u:"), "canonical").alias("k"), F.lit(None).cast("string").alias(rule),
                                        F.lit("block").alias(verdict), F.lit(1).alias(rank),
                                        F.struct(F.lit(0), F.lit(0), F.lit("")).alias("size")).distinct()))
    # rule paths have few lengths, at most those of a URL
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect() if r[0] is not None]
    labels = F.split(F.col(host), r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(F.length(F.col(path)) >= n, F.substring(F.col(path), 1, n)) for n in lengths] or [F.lit(None).cast("string")])
    asked = F.flatten(F.transform(suffixes, lambda h: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(F.lit("r:"), h, F.lit("|"), p))))
    asked = F.array_append(F.when(F.col(host) == "", F.array().cast("array<string>")).otherwise(asked),
                           F.when(F.col(canon) == "", None).otherwise(F.concat(F.lit("u:"), F.col(canon))))
    probes = urls.select(uid, F.explode(asked).alias(key)).where(F.col(key).isNotNull())
    hits = possible_hits(probes, key, keyed, "k").join(keyed, F.col(key) == F.col("k"))
    best = hits.groupBy(uid).agg(F.max_by(F.struct(F.col(rule).alias("r"), F.col(verdict).alias("v")),
                                          F.struct(-F.col(rank), F.col("size"))).alias(key))
    judged = urls.select(uid, host, path).join(best, uid, "left")
    out = pages.join(judged, col(url).eqNullSafe(F.col(uid)), "left")
    mine = {names[0]: F.coalesce(F.col(host), F.lit("")), names[1]: F.coalesce(F.col(path), F.lit("")),
            names[2]: F.col(key)["r"], names[3]: F.coalesce(F.col(key)["v"], F.lit("allow"))}
    return out.select(*[col(c) for c in pages.columns if c.lower() not in {n.lower() for n in names}],
                      *[v.alias(k) for k, v in mine.items()])
