"""SimHash near-dedup by a binary trie self-join.

Fingerprints: 64 bits over word shingles (XXH64, seed 42, repeats counted),
a bit being 1 if set in over half of the shingle hashes.  Two fingerprints
link when at most ``max_bits`` bits differ.

The join walks a binary trie with itself: node pairs descend together, a pair
adds one to its differing bits when its children's bits differ, and is
dropped once the error budget is exceeded.  To spread the trie over tasks,
the 64 bits are cut into ``max_bits + 1`` blocks; linked fingerprints agree
on at least one whole block, so one trie per block (with that block rotated
to the top) needs no errors in its top levels: the shuffle by (block, value)
resolves them, and tasks walk the sub-tries below.  A sub-trie with more
than ``max_group`` fingerprints is split again: its next ``SPLIT`` levels are
expanded into the node pairs within budget, and each pair is a unit of its
own.  Exact copies share one fingerprint, so they never meet in the join.

A task reports its links as stars (each fingerprint with one representative
of what it is connected to there), never all pairs of a group.  Components
over the stars come from alternating large-star and small-star rounds, each
written to the shared scratch folder.

Defined results: null text counts as empty; texts without words have
fingerprint zero, linked like any other; repeated rows and equal ids get the
same component; component_id is the smallest non-null id reachable (null if
all ids are null); extra columns are left alone; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import col, fresh
from tablekit.session import discard, materialize

SHINGLE = 3
MAX_BITS = 3
SPLIT = 4
MAX_GROUP = 1_000_000
_LEAF = 64          # node pairs with at most so many leaf pairs are compared leaf by leaf
_CHUNK = 1 << 19


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle))))
    ones, n = np.zeros(64, dtype=np.int64), 0
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(42))
    while True:
        h = np.fromiter(islice(hashes, _CHUNK >> 3), dtype="<u8")
        if not len(h):
            break
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return fingerprint


# ---------------------------------------------------------------- trie self-join

def _starts(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """For each node [lo, hi) of the sorted keys: where its keys with ``bit`` set begin."""
    lo, hi = lo.copy(), hi.copy()
    shift = np.uint64(bit)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = ((keys[np.minimum(mid, len(keys) - 1)] >> shift) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


class _Union:
    """Connected components over positions of one chunk."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def walk_trie(keys: np.ndarray, seeds: list[tuple[np.ndarray, ...]], depth: int, max_bits: int, found: _Union) -> None:
    """Descend node pairs (a_lo, a_hi, b_lo, b_hi, bits) of sorted ``keys``
    from ``depth`` and join every leaf pair with at most ``max_bits`` differing bits."""
    stack = [(depth, s) for s in seeds]
    while stack:
        d, (al, ah, bl, bh, bits) = stack.pop()
        if len(al) > _CHUNK:
            half = len(al) // 2
            stack += [(d, tuple(x[half:] for x in (al, ah, bl, bh, bits))), (d, tuple(x[:half] for x in (al, ah, bl, bh, bits)))]
            continue
        size = (ah - al) * (bh - bl)
        leaf = (size <= _LEAF) | (d >= 64)
        at = np.flatnonzero(leaf & ((size > 1) | (al != bl)))
        for part in np.array_split(at, max(1, -(-int(size[at].sum()) // (4 * _CHUNK)))):
            if len(part):
                nb = (bh - bl)[part]
                many = size[part]
                pair = np.repeat(np.arange(len(part)), many)
                k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                i, j = al[part][pair] + k // nb[pair], bl[part][pair] + k % nb[pair]
                keep = i < j
                i, j = i[keep], j[keep]
                close = np.bitwise_count(keys[i] ^ keys[j]) <= max_bits
                found.add(i[close], j[close])
        al, ah, bl, bh, bits = (x[~leaf] for x in (al, ah, bl, bh, bits))
        if not len(al):
            continue
        am, bm = _starts(keys, al, ah, 63 - d), _starts(keys, bl, bh, 63 - d)
        other = al != bl
        children = [
            (al, am, bl, bm, bits, None), (am, ah, bm, bh, bits, None),
            (al, am, bm, bh, bits + 1, None), (am, ah, bl, bm, bits + 1, other)]
        down = []
        for x0, x1, y0, y1, e, only in children:
            ok = (x0 < x1) & (y0 < y1) & (e <= max_bits)
            if only is not None:
                ok &= only
            down.append(tuple(x[ok] for x in (x0, x1, y0, y1, e)))
        merged = tuple(np.concatenate([c[k] for c in down]) for k in range(5))
        if len(merged[0]):
            stack.append((d + 1, merged))


def _join_chunk(rot: np.ndarray, unit: np.ndarray, keys: np.ndarray, tops: list[int], max_bits: int) -> _Union:
    """All groups of one chunk, sorted by (rotation, top block, unit, key)."""
    top = keys >> np.array([64 - t for t in tops], dtype=np.uint64)[rot]
    new = np.flatnonzero(np.r_[True, (rot[1:] != rot[:-1]) | (unit[1:] != unit[:-1]) | (top[1:] != top[:-1])])
    end = np.r_[new[1:], len(keys)]
    found = _Union(len(keys))
    none = np.zeros(len(new), dtype=np.int64)
    for t in sorted(set(tops)):
        mine = (np.array(tops)[rot[new]] == t) & (unit[new] < 0)
        if mine.any():
            walk_trie(keys, [(new[mine], end[mine], new[mine], end[mine], none[mine])], t, max_bits, found)
        for g in np.flatnonzero((np.array(tops)[rot[new]] == t) & (unit[new] >= 0)):
            p, q = divmod(int(unit[new[g]]), 1 << SPLIT)
            lo, hi = new[g:g + 1], end[g:g + 1]
            if p == q:
                walk_trie(keys, [(lo, hi, lo, hi, none[:1])], t + SPLIT, max_bits, found)
            else:  # q's keys follow p's
                sub = (keys[lo[0]:hi[0]] >> np.uint64(64 - t - SPLIT)) & np.uint64((1 << SPLIT) - 1)
                mid = lo + int((sub == p).sum())
                walk_trie(keys, [(lo, mid, mid, hi, none[:1] + (p ^ q).bit_count())], t + SPLIT, max_bits, found)
    return found


def trie_links(fingerprints: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): stars over distinct ``fp`` (long) that connect all fingerprints
    within ``max_bits`` of each other."""
    n = max_bits + 1
    offsets = [64 * k // n for k in range(n + 1)]
    tops = [offsets[k + 1] - offsets[k] for k in range(n)]

    def rotated(k: int):
        fp, s = F.col("fp"), offsets[k]
        return fp if not s else F.shiftleft(fp, s).bitwiseOR(F.shiftrightunsigned(fp, 64 - s))

    parts = F.array(*[F.struct(F.lit(k).alias("rot"), rotated(k).alias("key"),
                               F.shiftrightunsigned(rotated(k), 64 - tops[k]).alias("top")) for k in range(n)])
    rows = fingerprints.select(F.explode(parts).alias("p")).select("p.rot", "p.key", "p.top")
    groups = rows.groupBy("rot", "top").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
    if groups.isEmpty():
        units = rows.withColumn("unit", F.lit(-1))
    else:
        below = F.element_at(F.array(*[F.lit(t) for t in tops]), F.col("rot") + 1)
        sub = F.shiftrightunsigned(F.call_function("shiftleft", F.col("key"), below), 64 - SPLIT).cast("int")
        mates = F.filter(F.sequence(F.lit(0), F.lit((1 << SPLIT) - 1)),
                         lambda q: F.bit_count(q.bitwiseXOR(F.col("sub"))) <= max_bits)
        pair = F.transform(mates, lambda q: F.least(q, F.col("sub")) * (1 << SPLIT) + F.greatest(q, F.col("sub")))
        units = (rows.withColumn("sub", sub).join(groups, ["rot", "top"], "left")
                 .select("rot", "key", "top", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(-1))).otherwise(pair)).alias("unit")))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = np.array(offsets[:-1], dtype=np.uint64)

        def stars(rot, unit, keys):
            found = _join_chunk(rot, unit, keys, tops, max_bits)
            at = np.flatnonzero(found.root != np.arange(len(keys)))
            if not len(at):
                return
            s = back[rot[at]]
            turn = lambda k: np.where(s == 0, k, (k >> s) | (k << ((np.uint64(64) - s) & np.uint64(63)))).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(turn(keys[at]).view(np.int64)), pa.array(turn(keys[found.root[at]]).view(np.int64))], names=["a", "b"])

        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)]
        for batch in batches:
            got = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            got[2] = got[2].astype(np.int64).view(np.uint64)
            held = [np.concatenate([h, g.astype(h.dtype)]) for h, g in zip(held, got)]
            if len(held[0]) >= _CHUNK:
                rot, unit, keys, top = held
                last = len(rot) - 1
                edge = np.flatnonzero((rot != rot[last]) | (unit != unit[last]) | (top != top[last]))
                cut = int(edge[-1]) + 1 if len(edge) else 0
                if cut:
                    yield from stars(rot[:cut], unit[:cut], keys[:cut])
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield from stars(*held[:3])

    spread = (units.select("rot", "unit", "key", "top").repartition("rot", "top", "unit")
              .sortWithinPartitions("rot", "top", "unit", "key"))  # one sign within a top block
    return spread.mapInArrow(join, "a long, b long")


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b): alternating large-star
    and small-star rounds until nothing changes.  Each round groups by node
    with map-side minima only, so a hub costs no large group."""
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        now = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark or now["n"] == 0:
            break
        mark = now
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v"))
        extra = low.select("u", F.col("m").alias("v"))
        old, cur = cur, materialize(small.unionByName(extra).where("u <> v").distinct(), "stars")
        discard(old)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


# ---------------------------------------------------------------- the operator

def fingerprint_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                           max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, fp, component_id, root.
    The root is a fingerprint of the component and its own in each of them;
    components that share their smallest id, or have none, differ in it."""
    marked = materialize(docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_key"),
                                     fingerprint_udf(shingle)(col(text)).alias("fp")), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    linked = components(trie_links(nodes.select("fp"), max_bits, max_group))
    ids = nodes.join(linked, F.col("fp") == F.col("node")).select("fp", "root", "first_id")
    lowest = ids.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = ids.select("fp", "root").join(lowest, "root").select("fp", "root", "component_id")
    found = nodes.join(of, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"),
                                                F.coalesce("root", "fp").alias("root"))
    # written, so that the last join has a shuffle on both sides and AQE can split a fingerprint of very many copies
    return marked.join(materialize(found, "fingerprint-components"), "fp")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null
    ids last; among rows with equal id, the smallest text key)."""
    key, mine, other, at = fresh(docs, "key", "id", "text", "at")
    marked = fingerprint_components(docs, doc_id, text, shingle, max_bits, max_group)
    first = marked.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))).alias("k"))
    first = first.select(F.col("k.doc_id").alias(mine), F.col("k.text_key").alias(other))
    held = docs.withColumn(key, F.xxhash64(col(text))).join(
        first, col(doc_id).eqNullSafe(F.col(mine)) & (F.col(key) == F.col(other)), "left_semi")
    order = Window.partitionBy(col(doc_id), F.col(key)).orderBy(F.col(key))
    return held.withColumn(at, F.row_number().over(order)).where(F.col(at) == 1).drop(at, key)
