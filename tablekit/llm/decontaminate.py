"""Benchmark decontamination (DataFrame functions only).

A document is contaminated by an item when a window of the item's size holds
the item's word shingles with weighted (multiset) similarity of at least
``similarity``: sum of the smaller counts over sum of the larger ones.

1. Anchors.  A window of m shingles that reaches similarity s shares
   need = ceil(2 m s / (1 + s)) of the item's m shingle occurrences, so it
   holds at least one of any m - need + 1 of them.  A document of fewer than
   m shingles is one window that may qualify with ceil(m s) shared, so such
   documents meet m - ceil(m s) + 1 anchors.  Documents meet only these
   anchors; windows without one cannot qualify.  Each window around an
   anchor is made once for each item, by its first anchor.
2. SimHash of each item-sized window and of each item (64 bits over the
   shingle hashes), and multi-index Hamming blocks: the 64 bits are cut into
   ``radius + 1`` blocks; fingerprints within ``radius`` bits agree on one
   block at least, so the join on (item, block, value) finds all of them; a
   pair counts at its first agreeing block only.
3. Verification: the exact weighted similarity.

Words are runs of letters and digits (and all non-ASCII characters), lower
case; texts with fewer words than ``shingle`` are one shingle; a document
shorter than an item is one window.  The anchor table is broadcast only up
to ``max_broadcast`` rows; beyond, document shingles are shuffled to it.

Items are told apart by a hash of their shingles, never by their id alone.

Defined results: null and empty texts and items match nothing; rows with
equal id and text are one document; items with equal text are all reported,
rows that share an item id count each for itself, and the best one is given;
a null item id is an id like any other, so its items are found and dropped;
ties of similarity keep the first window; extra columns are left alone;
empty tables give no matches and leave all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import col, computed, fresh
from tablekit.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24
MAX_BROADCAST = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATORS, -1), lambda w: w != "")


def _gram(words: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(k)])


def _grams(words: Column, k: int) -> Column:
    """All k-word shingle hashes, in order."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: _gram(words, i, k))


def _with_simhash(rows: DataFrame, grams: str, name: str) -> DataFrame:
    """``rows`` plus the 64-bit SimHash of an array of hashes: a bit is 1 if set
    in over half of them.  Two 32-bit counters share each of 32 running sums."""
    zero, pair = F.lit(0).cast("long"), F.lit(0x0000000100000001).cast("long")
    low = F.lit(0xFFFFFFFF).cast("long")
    places = F.sequence(F.lit(0), F.lit(31))
    shifted = lambda h, b: F.call_function("shiftrightunsigned", h, b)
    sums = F.transform(places, lambda b: F.aggregate(
        F.col(grams), zero, lambda a, h: a + shifted(h, b).bitwiseAND(pair)))
    one, n = F.lit(1).cast("long"), F.size(grams)

    def bits(count: Column, place: Column) -> Column:
        return F.when(count * 2 > n, F.call_function("shiftleft", one, place)).otherwise(zero)

    word = F.aggregate(F.arrays_zip(places.alias("b"), F.col("__sums").alias("s")), zero, lambda a, x: a.bitwiseOR(
        bits(x["s"].bitwiseAND(low), x["b"])).bitwiseOR(bits(F.shiftrightunsigned(x["s"], 32), x["b"] + 32)))
    return computed(computed(rows, "__sums", sums), name, word).drop("__sums")


def _numbered(grams: Column) -> Column:
    """A multiset as a set: each hash with its occurrence number."""
    ordered = F.sort_array(grams)
    return F.transform(ordered, lambda h, i: F.xxhash64(h, i - F.array_position(ordered, h).cast("int")))


def _blocks(fp: Column, radius: int) -> Column:
    n = radius + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return F.array(*[F.shiftrightunsigned(F.shiftleft(fp, cuts[k]), 64 - (cuts[k + 1] - cuts[k])) for k in range(n)])


def _items(benchmark: DataFrame, item_id: str, text: str, k: int, similarity: float) -> DataFrame:
    """(item_id, k, m, n_words, grams, need, least): items with their shingles."""
    texts = benchmark.select(col(item_id).alias("item_id"), col(text).alias("text"))
    words = computed(texts, "words", _words(F.col("text"))).drop("text").where(F.size("words") > 0)
    short = [words.where(F.size("words") == j).withColumn("k", F.lit(j)).withColumn("grams", _grams(F.col("words"), j))
             for j in range(1, k)]
    out = words.where(F.size("words") >= k).withColumn("k", F.lit(k)).withColumn("grams", _grams(F.col("words"), k))
    for s in short:
        out = out.unionByName(s)
    m = F.size("grams")
    return out.select("item_id", "k", m.alias("m"), F.size("words").alias("n_words"), "grams",
                      F.ceil(F.lit(2 * similarity / (1 + similarity)) * m - 1e-9).cast("int").alias("need"),
                      F.ceil(F.lit(similarity) * m - 1e-9).cast("int").alias("least"))


def _windows(docs: DataFrame, anchors: DataFrame, k: int, broadcast: bool) -> DataFrame:
    """(doc_id, text_key, item_id, row, m, start, grams): each window that holds an anchor of its item."""
    rows = computed(docs, "words", _words(F.col("text"))).select("doc_id", "text_key", "words")
    n = F.size("words") - (k - 1)
    at = rows.where(n > 0).select("doc_id", "text_key", "words", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    gram = _gram(F.col("words"), F.col("i"), k).alias("gram")
    # the words that windows around shingle i can reach
    first = F.greatest(F.col("i") - F.col("m") + 1, F.lit(0))
    reach = F.slice("words", first + 1, 2 * F.col("m") + k - 2)
    if broadcast:
        hits = (at.select("doc_id", "text_key", "words", "i", gram).join(F.broadcast(anchors), "gram")
                .where(~F.col("short") | (n < F.col("m")))
                .select("doc_id", "text_key", "item_id", "row", "m", "i", n.alias("n"), first.alias("first"), reach.alias("words")))
    else:
        found = at.select("doc_id", "text_key", "i", gram).join(anchors, "gram").drop("gram").distinct()
        mine = rows.withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "t")
        hits = (found.join(mine, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
                .where(~F.col("short") | (n < F.col("m")))
                .select("doc_id", "text_key", "item_id", "row", "m", "i", n.alias("n"), first.alias("first"), reach.alias("words")))
    of = ["doc_id", "text_key", "item_id", "m", "row"]
    # a fixed count: the work is in the windows to come, which the bytes of these few rows do not tell
    hits = hits.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *of)
    before = F.lag("i").over(Window.partitionBy(*of).orderBy("i"))
    size = F.least("m", "n")
    lo = F.greatest(F.col("i") - size + 1, F.coalesce(F.col("before") + 1, F.lit(0)), F.lit(0))
    hi = F.least(F.col("i"), F.col("n") - size)
    starts = F.when(lo <= hi, F.sequence(lo, hi))
    each = (hits.withColumn("before", before)
            .select(*of, size.alias("size"), "first", "words", F.explode(starts).alias("start")))
    grams = F.transform(F.sequence(F.col("start") - F.col("first"), F.col("start") - F.col("first") + F.col("size") - 1),
                        lambda i: _gram(F.col("words"), i, k))
    return computed(each, "grams", grams).select(*of, "start", "grams")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                 similarity: float = SIMILARITY, radius: int = RADIUS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(doc_id, text_key, item_id, start, n_words, similarity): the best window
    of every document and item that match."""
    items = materialize(_items(benchmark, item_id, item_text, shingle, similarity), "items")
    often = items.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    rarity = Window.partitionBy("item_id", "k", "m", "need", "row").orderBy("often", "gram")
    numbered = items.withColumn("row", F.xxhash64("grams")).dropDuplicates(["item_id", "k", "m", "row"])
    anchors = (numbered.select("item_id", "k", "m", "need", "least", "row", F.explode("grams").alias("gram")).join(often, "gram")
               .withColumn("rank", F.row_number().over(rarity)).where(F.col("rank") <= F.col("m") - F.col("least") + 1)
               # anchors that only documents shorter than the item need
               .groupBy("k", "gram", "item_id", "m", "row").agg(F.min(F.col("rank") > F.col("m") - F.col("need") + 1).alias("short")))
    anchors = materialize(anchors, "anchors")
    sizes = {r["k"]: r["n"] for r in anchors.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `shingle` rows
    rows = docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_key"), col(text).alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    parts = [_windows(rows, anchors.where(F.col("k") == k).drop("k"), k, n <= max_broadcast).withColumn("k", F.lit(k))
             for k, n in sorted(sizes.items())]
    if not parts:
        return rows.limit(0).select("doc_id", "text_key", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"),
                                    F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0.0).alias("similarity"))
    windows = parts[0]
    for p in parts[1:]:
        windows = windows.unionByName(p)
    windows = _with_simhash(windows, "grams", "fp")
    known = materialize(_with_simhash(numbered.dropDuplicates(["k", "m", "row"]), "grams", "i_fp").select(
        F.col("k").alias("i_k"), F.col("m").alias("i_m"), F.col("row").alias("i_row"), "n_words", F.col("grams").alias("i_grams"),
        "i_fp"), "item-hashes")
    index = known.select("i_k", "i_m", "i_row", "i_fp", F.posexplode(_blocks(F.col("i_fp"), radius)).alias("i_block", "i_value"))
    if sum(sizes.values()) * (radius + 1) <= max_broadcast:  # an item has an anchor at least, so this bounds the index
        index = F.broadcast(index)
    keyed = windows.select("*", F.posexplode(_blocks(F.col("fp"), radius)).alias("block", "value"))
    same = (F.col("k") == F.col("i_k")) & (F.col("m") == F.col("i_m")) & (F.col("row") == F.col("i_row"))
    pairs = keyed.join(index, same & (F.col("block") == F.col("i_block")) & (F.col("value") == F.col("i_value")))
    xor = F.col("fp").bitwiseXOR(F.col("i_fp"))
    near = pairs.where(F.bit_count(xor) <= radius)
    first = F.array_position(_blocks(xor, radius), F.lit(0).cast("long")) - 1 == F.col("block")
    near = near.where(first).select("doc_id", "text_key", "item_id", "k", "m", "row", "start", "grams")
    both = near.join(known.select("i_k", "i_m", "i_row", "n_words", "i_grams"), same)
    both = computed(both, "shared", F.size(F.array_intersect(_numbered(F.col("grams")), _numbered(F.col("i_grams")))))
    exact = F.col("shared") / (F.size("grams") + F.size("i_grams") - F.col("shared"))
    verified = (both.select("doc_id", "text_key", "item_id", "start", "n_words", exact.alias("similarity"))
                .where(F.col("similarity") >= similarity))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words"))
    return (verified.groupBy("doc_id", "text_key", "item_id").agg(best.alias("b"))
            .select("doc_id", "text_key", "item_id", (-F.col("b.back")).alias("start"), "b.n_words", "b.similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    d, t = fresh(docs, "id", "key")
    found = contaminated(docs, benchmark, doc_id, text, **options)
    listed = materialize(found.select(F.col("doc_id").alias(d), F.col("text_key").alias(t)).distinct(), "contaminated")
    return docs.join(listed, col(doc_id).eqNullSafe(F.col(d)) & (F.xxhash64(col(text)) == F.col(t)), "left_anti")
