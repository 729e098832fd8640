"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut, without loss, into leaves; leaves make paragraphs (lines),
paragraphs make sections, sections the root.  All cuts below lines depend on
the text nearby only, so an edit changes the leaves it touches and the nodes
above them:

* leaf: a run of words up to a word whose bytes sum to a cut (one in
  ``LEAF_WORDS`` words), or of ``LONGEST`` words without one; in paragraphs
  under ``SHORT`` words every word is a leaf, and under 3 words every 3 bytes;
* section: paragraphs up to one whose hash is a cut (one in 8).

A paragraph's node is the BLAKE2b of its leaves' bytes, a section's that of its
paragraphs' nodes, the root that of the sections' nodes, 128 bits each.  A
fingerprint is ``root|section:paragraph.paragraph/section:...`` in hex: the
root, 32 bits of a section, and 32 bits of a hash of each leaf.  Equal texts have
equal fingerprints, equal roots mean equal texts (up to collisions of BLAKE2b),
and comparing from the root down finds the branches that differ.  Likeness is the
share of leaves that two trees have in common (2 * common / all).

Defined results: null text is empty; the empty text has a tree without
leaves, which is like itself (1) and unlike any other (0); extra columns are
left alone; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.common import col, fresh
from tablekit.llm.sharding import Key, quantile_splitters, ranges_of

SAMPLES, ROWS_PER_BUCKET, BUCKET_BYTES = 32, 20_000, 32 << 20
LEAF_WORDS, LONGEST, SHORT, SECTION = 4, 12, 8, 8
_LAST = (1 << 63) - 1

_rng = np.random.default_rng(20240611)
_TABLE = _rng.integers(0, 2**64, size=256, dtype=np.uint64)
_STEP = np.uint64(int(_rng.integers(0, 2**63)) * 2 + 1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _leaf_hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes that begins at ``starts``: every (byte, place)
    is mixed on its own, so no arithmetic of the bytes cancels out."""
    sizes = np.diff(np.r_[starts, len(raw)])
    place = (np.arange(len(raw)) - np.repeat(starts, sizes)).astype(np.uint64)
    return _mix(np.add.reduceat(_mix(_TABLE[raw] ^ (place * _STEP)), starts) + _mix(sizes.astype(np.uint64)))


def _leaf_starts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where leaves begin, and which of them begin a paragraph."""
    n = len(raw)
    line = np.r_[0, np.flatnonzero(raw[:-1] == 10) + 1]              # a paragraph ends with its line feed
    space = _SPACE[raw]
    begins = np.flatnonzero(~space & np.r_[True, space[:-1]])
    ends = np.flatnonzero(np.r_[space, True] & np.r_[False, ~space])  # the place after each word
    many = np.diff(np.r_[np.searchsorted(begins, line), len(begins)])
    total = np.r_[np.uint64(0), np.cumsum(_TABLE[raw])]
    cut = _mix(total[ends] - total[begins]) % np.uint64(LEAF_WORDS) == 0
    words = many[np.searchsorted(line, begins, side="right") - 1]
    k = np.arange(len(ends))
    since = k - np.maximum.accumulate(np.where(cut, k, -1))
    run = (words < SHORT) | cut | (since % LONGEST == 0)
    run &= ends < n
    words = many
    at = [line, ends[run] + 1]
    for k in np.flatnonzero(words < 3):
        at.append(np.arange(line[k], line[k + 1] if k + 1 < len(line) else n, 3))
    starts = np.unique(np.concatenate(at))
    starts = starts[starts < n]
    return starts, np.searchsorted(starts, line)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str | None) -> str:
    """The tree of one text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return hashlib.blake2b(b"", digest_size=16).hexdigest() + "|"
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, paragraphs = _leaf_starts(raw)
    hexed = _leaf_hashes(raw, starts).astype(">u4").tobytes().hex()
    edges = [*(8 * paragraphs).tolist(), len(hexed)]
    lines = [hexed[a:b] for a, b in zip(edges, edges[1:])]
    cuts = [*starts[paragraphs].tolist(), len(data)]
    nodes = [_digest(data[a:b]) for a, b in zip(cuts, cuts[1:])]
    ends = [k + 1 for k, node in enumerate(nodes) if node[0] % SECTION == 0]
    bounds = [0, *ends] if ends and ends[-1] == len(nodes) else [0, *ends, len(nodes)]
    sections = [_digest(b"".join(nodes[a:b])) for a, b in zip(bounds, bounds[1:])]
    root = _digest(b"".join(sections) + len(data).to_bytes(8, "little")).hex()
    return root + "|" + "/".join(
        head[:4].hex() + ":" + ".".join(lines[a:b]) for head, a, b in zip(sections, bounds, bounds[1:]))


def _leaves(tree: str) -> np.ndarray:
    sections = tree.partition("|")[2].split("/")
    return np.frombuffer(bytes.fromhex("".join(s[9:].replace(".", "") for s in sections)), dtype=">u4")


def likeness(one: str, other: str) -> float:
    """Share of leaves in common, 0 to 1, from the fingerprints alone."""
    if one == other:
        return 1.0
    a, b = _leaves(one), _leaves(other)
    if not len(a) or not len(b):
        return 0.0
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(vb, va), len(vb) - 1)
    common = int(np.where(vb[at] == va, np.minimum(ca, cb[at]), 0).sum())
    return 2 * common / (len(a) + len(b))


def locate_edits(one: str, other: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``one`` that ``other`` lacks: roots first, then
    sections, and paragraphs of differing sections only."""
    if one.partition("|")[0] == other.partition("|")[0]:
        return []
    mine, theirs = (t.partition("|")[2].split("/") for t in (one, other))
    known = set(theirs)
    paragraphs = {p for s in theirs for p in s[9:].split(".")}
    return [(k, j) for k, s in enumerate(mine) if s not in known
            for j, p in enumerate(s[9:].split(".")) if p not in paragraphs]


def fingerprint_udf():
    @F.pandas_udf("string")
    def tree(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype=object)

    return tree


# ---------------------------------------------------------------- neighbours by id

def _buckets(rows: DataFrame, order: str, key: str, bucket_bytes: int) -> tuple[list[Key], dict[tuple[int, int], int]]:
    """Range borders of (``order``, ``key``) that cut a sample, weighted by
    bytes, into equal buckets of about ``bucket_bytes``; and the bucket before
    each bucket by its first (order, key).  The driver holds ``SAMPLES`` keys a bucket."""
    n_rows = rows.count()
    least = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rate = min(1.0, SAMPLES * max(least, n_rows / ROWS_PER_BUCKET) / max(1, n_rows))
    drawn = F.pmod(F.xxhash64(F.lit("bucket"), order, key), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    sample = [((r[0], r[1], 0), float(r[2])) for r in rows.where(drawn).select(order, key, size).collect()]
    n = max(least, -(-int(sum(w for _, w in sample) / rate) // bucket_bytes))
    borders = quantile_splitters(sample, n)

    @F.pandas_udf("int")
    def bucket(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(ranges_of(borders, [a.to_numpy(), b.to_numpy(), np.zeros(len(a), dtype=np.int64)]).astype(np.int32))

    firsts = sorted((r["b"], tuple(r["k"])) for r in rows.groupBy(bucket(order, key).alias("b")).agg(
        F.min(F.struct(order, key)).alias("k")).collect())
    return borders, {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}


def compare_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Each document with an edit of its own (its last quarter replaced by the
    start of the next document by id; the last one's next is the first) and
    with that next document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Texts move once: to the range bucket of their id, one bucket to a task; the
    first document of a bucket also goes to the bucket before, so every task finds
    its neighbours while it streams.  Null ids come last; equal ids go by a hash of
    the text, which also spreads them over buckets.  Ids are whole numbers."""
    order, key = fresh(docs, "order", "key")
    rows = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(doc_id).cast("long"), F.lit(_LAST)).alias(order),
                       F.xxhash64(col(text)).alias(key), col(text).alias("text"))
    borders, before = _buckets(rows, order, key, bucket_bytes)

    @F.pandas_udf("array<int>")
    def places(k: pd.Series, h: pd.Series) -> pd.Series:
        own = ranges_of(borders, [k.to_numpy(), h.to_numpy(), np.zeros(len(k), dtype=np.int64)]).tolist()
        return pd.Series([[b, before[v]] if v in before else [b] for v, b in zip(zip(k.tolist(), h.tolist()), own)])

    dealt = rows.select(F.posexplode(places(order, key)).alias("guest", "bucket"), "doc_id", order, key, "text")
    near = (dealt.repartitionById(len(borders) + 1, "bucket").sortWithinPartitions("bucket", "guest", order, key)
            .select("bucket", "guest", "doc_id", "text"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        held = None                      # the row that waits for its next one
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for bucket, guest, doc, body in zip(*(c.to_pylist() for c in batch.columns)):
                body = body or ""
                tree = None
                if held is not None and held[0] == bucket:
                    _, mine, own, own_tree = held
                    tree = fingerprint(body)
                    k = len(own) // 4
                    edited = own[:len(own) - k] + body[:k]
                    edited_tree = fingerprint(edited)
                    out.append((mine, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_tree,
                                edited_tree, likeness(own_tree, edited_tree), likeness(own_tree, tree)))
                held = None if guest else (bucket, doc, body, tree or fingerprint(body))
                if len(out) >= 500:
                    yield batch_of()
        if out:
            yield batch_of()

    return near.mapInArrow(run, schema)
