"""Suffix-array dedup: removes every byte covered by a ``width``-byte string
that also starts earlier in the corpus (smaller id, or earlier in the same
document), by deep-shallow suffix sorting.

Sorting a suffix for every byte of a corpus would move a hundred bytes per
byte, so the suffix array is a sparse one:

1. Anchors.  Each ``width``-byte window names the position of its smallest
   ``GRAM``-byte hash (the leftmost of equal ones).  Equal windows name the
   same place within themselves, so equal windows always share an anchor's
   hash and offset.  Runs of windows with one anchor form a context (at most
   2 * width bytes); about one position in 40 is an anchor.
2. Equal contexts.  Rows (anchor hash, context hash, place) are shuffled by
   anchor; later rows of an equal context are wholly repeated.  Each task
   first settles equal contexts within itself and sends only the earliest, so
   a passage that a third of the documents share costs one row per task.
3. Suffix sorting.  Anchors with several different contexts may still share
   windows: the contexts' bytes are fetched, and the suffixes from the anchor
   on, and the reversed bytes before it, are sorted per anchor by deep-shallow
   sorting: multikey quicksort over ``LETTER``-byte letters to ``SHALLOW``
   bytes, then blind tries for groups that still agree.  Neighbours' common
   prefixes tell which windows are equal; all but the earliest are repeated.
   An anchor with more than ``max_group`` contexts is split: its windows are
   dealt again by the hash of their whole content, after another round of 2.
4. The spans of each document are merged and cut out.

Nothing is capped: the bound on a group only picks how it is dealt out.

Defined results: null text is empty; texts under ``width`` bytes lose nothing;
rows with equal id and text are one document; rows with equal id and other
text are ordered by a hash of the text; a null id comes after all others;
extra columns are left alone; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import col, fresh
from tablekit.session import materialize

WIDTH = 100
GRAM = 28
LETTER, SHALLOW = 8, 24
MAX_GROUP = 100_000
_SEGMENT = 1 << 20
_FLUSH = 1 << 20
_LAST = (1 << 63) - 1

_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(0, 2**64, size=256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 2**63)) * 2 + 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (mod 2**64), at least n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * _SEGMENT)
        inverse = pow(_BASE, -1, 2**64)
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, b, dtype=np.uint64)]) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def contexts(segments: list[bytes], width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(segment, first window, bytes, offset of the anchor, anchor hash,
    context hash) of each run of windows that share an anchor."""
    raw = np.frombuffer(b"".join(segments), dtype=np.uint8)
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes)
    windows = sizes >= width
    if not windows.any():
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    up, down = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[raw] * up[:len(raw)], out=total[1:])
    hashes = _mix((total[gram:] - total[:-gram]) * down[:len(raw) - gram + 1])
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    reach, span = 1, width - gram + 1
    while reach < span:  # sliding minimum by doubling
        step = min(reach, span - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    del low
    start = ends - sizes
    first = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(first, start[windows], 1)
    np.add.at(first, (ends - width + 1)[windows], -1)
    at = np.flatnonzero(np.cumsum(first[:len(anchor)]) > 0)
    named = anchor[at]
    new = np.flatnonzero(np.r_[True, (named[1:] != named[:-1]) | (at[1:] != at[:-1] + 1)])
    lo, hi = at[new], at[np.r_[new[1:], len(at)] - 1]
    where = named[new]
    segment = np.searchsorted(ends, lo, side="right")
    size, offset = hi + width - lo, where - lo
    body = (total[hi + width] - total[lo]) * down[lo]
    shape = _mix((size.astype(np.uint64) << np.uint64(32)) | offset.astype(np.uint64))
    return segment, lo - start[segment], size, offset, hashes[where], _mix(body ^ shape)


def _spans(order: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of one document as one."""
    by = np.lexsort((at, order))
    order, at, end = order[by], at[by], at[by] + size[by]
    doc = np.flatnonzero(np.r_[True, (order[1:] != order[:-1]) | (at[1:] >> 31 != at[:-1] >> 31)])
    out = [np.maximum.accumulate(x) for x in np.split(end, doc[1:])] if len(doc) < 2000 else None
    if out is None:
        most = np.empty_like(end)
        for a, b in zip(doc, np.r_[doc[1:], len(end)]):
            most[a:b] = np.maximum.accumulate(end[a:b])
    else:
        most = np.concatenate(out)
    new = np.flatnonzero(np.r_[True, (order[1:] != order[:-1]) | (at[1:] > most[:-1])])
    return order[new], at[new], most[np.r_[new[1:], len(most)] - 1] - at[new]


_ROW = "kind int, anchor long, context long, doc_order long, at long, size int, off int"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _rows(kind: int, anchor, context, order, at, size, off) -> pa.RecordBatch:
    n = len(order)
    ints = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t, copy=False), type=pa.from_numpy_dtype(t))
    view = lambda x: x.view(np.int64) if isinstance(x, np.ndarray) and x.dtype == np.uint64 else x
    return pa.RecordBatch.from_arrays(
        [ints(kind, np.int32), ints(view(anchor), np.int64), ints(view(context), np.int64), ints(order, np.int64),
         ints(at, np.int64), ints(size, np.int32), ints(off, np.int32)], names=_NAMES)


def _settle(anchor, context, order, at, size, off) -> Iterator[pa.RecordBatch]:
    """Equal contexts within one task: the earliest goes on (kind 0), the
    others are spans (kind 1, dealt by their document)."""
    by = np.lexsort((at, order, context, anchor))
    anchor, context, order, at, size, off = (x[by] for x in (anchor, context, order, at, size, off))
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    yield _rows(0, anchor[new], context[new], order[new], at[new], size[new], off[new])
    again = ~new & ((order != order[first]) | (at != at[first]))
    if again.any():
        o, a, s = _spans(order[again], at[again], size[again].astype(np.int64))
        yield _rows(1, o, 0, o, a, s, 0)


def _anchor_rows(width: int, gram: int) -> Callable:
    """Task: documents (doc_order, tag, text) to anchor rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: list[bytes] = []
        origin: list[tuple[int, int]] = []
        held: list[tuple[np.ndarray, ...]] = []
        size = rows = 0

        def block() -> None:
            nonlocal size, rows
            seg, lo, n, off, anchor, context = contexts(segments, width, gram)
            if len(seg):
                base = np.array(origin, dtype=np.int64)[seg]
                held.append((anchor, context, base[:, 0], base[:, 1] + lo, n.astype(np.int32), off.astype(np.int32)))
                rows += len(seg)
            segments.clear()
            origin.clear()
            size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            if held:
                yield from _settle(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            rows = 0

        for batch in batches:
            for order, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = memoryview(text.as_buffer()) if text.is_valid else b""
                # long texts go in segments whose windows do not overlap
                for a in range(0, max(1, len(raw) - width + 1), _SEGMENT):
                    part = bytes(raw[a:a + _SEGMENT + width - 1])
                    if len(part) < width:
                        continue
                    segments.append(part)
                    origin.append((order, (tag << 31) + a))
                    size += len(part)
                    if size >= _SEGMENT:
                        block()
                        if rows >= _FLUSH:
                            yield from flush()
        if segments:
            block()
        yield from flush()

    return run


def _compare_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows sorted by (kind, anchor, context, doc_order, at).  Later rows of an
    equal context become spans; the earliest rows of anchors with several
    contexts become requests (kind 2).  Holds one batch and one row."""
    last = None          # (anchor, context, order, at of the context's first row)
    waiting = None       # the first context of the current anchor, while it is the only one
    for batch in batches:
        for part in range(0, batch.num_rows, 1 << 17):
            rows = batch.slice(part, 1 << 17)
            kind, anchor, context, order, at, size, off = (rows.column(k).to_numpy() for k in range(7))
            span = kind == 1
            if span.any():
                yield rows.filter(pa.array(span))
                kind, anchor, context, order, at, size, off = (x[~span] for x in (kind, anchor, context, order, at, size, off))
            if not len(kind):
                continue
            new_a = np.r_[last is None or anchor[0] != last[0], anchor[1:] != anchor[:-1]]
            new_c = new_a | np.r_[last is None or context[0] != last[1], context[1:] != context[:-1]]
            idx = np.maximum.accumulate(np.where(new_c, np.arange(len(kind)), -1))
            f_order = np.where(idx >= 0, order[idx], last[2] if last else 0)
            f_at = np.where(idx >= 0, at[idx], last[3] if last else 0)
            again = ~new_c & ((order != f_order) | (at != f_at))
            if again.any():
                yield _rows(1, order[again], 0, order[again], at[again], size[again], 0)
            reps = np.flatnonzero(new_c)
            if len(reps):
                head = new_a[reps]                                   # first context of its anchor
                follows = np.r_[~head[1:], False]                    # its anchor has another context in this batch
                ask = ~head | follows
                if waiting is not None:
                    if not head[0]:
                        yield _rows(2, *waiting)
                    waiting = None
                take = reps[ask]
                if len(take):
                    yield _rows(2, anchor[take], context[take], order[take], at[take], size[take], off[take])
                if head[-1]:
                    r = reps[-1:]
                    waiting = tuple(x[r] for x in (anchor, context, order, at, size, off))
            last = (anchor[-1], context[-1], f_order[-1], f_at[-1])


# ---------------------------------------------------------------- deep-shallow sorting

def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - 1 - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() - 1) // 8


class _BlindTrie:
    """Sorts strings by their branching bytes only: a string goes down the
    trie without looking at skipped bytes, is compared once with the leaf it
    reaches, and branches off where they differ."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.top: list | None = None   # inner node: [depth, {byte: node}]; leaf: [-1, [ids]]

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.top is None:
            self.top = [-1, [i]]
            return
        path, node = [], self.top
        while node[0] >= 0:
            path.append(node)
            d, kids = node
            node = kids.get(s[d] if d < len(s) else -1) or next(iter(kids.values()))
        other = self.strings[node[1][0]]
        n = _common(s, other)
        if n == len(s) == len(other):
            node[1].append(i)
            return
        k = 0
        while k < len(path) and path[k][0] < n:
            k += 1
        mine = s[n] if n < len(s) else -1
        if k < len(path) and path[k][0] == n:
            path[k][1][mine] = [-1, [i]]
            return
        below = path[k] if k < len(path) else node
        branch = [n, {mine: [-1, [i]], (other[n] if n < len(other) else -1): below}]
        if k == 0:
            self.top = branch
        else:
            d, kids = path[k - 1]
            kids[s[d] if d < len(s) else -1] = branch

    def walk(self) -> tuple[list[int], list[int]]:
        """Ids in order, and each one's common prefix with the one before."""
        out: list[int] = []
        common: list[int] = []
        stack = [(self.top, 0)]
        while stack:
            node, lead = stack.pop()
            if node[0] < 0:
                n = len(self.strings[node[1][0]])
                out += node[1]
                common += [lead] + [n] * (len(node[1]) - 1)
            else:
                d, kids = node
                keys = sorted(kids)
                stack += [(kids[k], d) for k in reversed(keys[1:])] + [(kids[keys[0]], lead)]
        return out, common


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW, letter: int = LETTER) -> tuple[list[int], list[int]]:
    """Order of ``strings`` and each one's common prefix with the one before it (first: 0)."""
    order: list[int] = []
    common: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        ids, depth = stack.pop()
        if len(ids) == 1:
            order += ids
            common.append(-1)
        elif depth >= shallow:
            trie = _BlindTrie(strings)
            for i in ids:
                trie.insert(i)
            got, lcp = trie.walk()
            order += got
            common += [-1] + lcp[1:]
        else:  # ternary split by the letter at this depth
            letters = [strings[i][depth:depth + letter] for i in ids]
            pivot = sorted((letters[0], letters[len(ids) // 2], letters[-1]))[1]
            less = [i for i, x in zip(ids, letters) if x < pivot]
            same = [i for i, x in zip(ids, letters) if x == pivot]
            more = [i for i, x in zip(ids, letters) if x > pivot]
            # strings that end in the letter are equal: straight to the trie
            deeper = depth + letter if len(pivot) == letter else shallow
            stack += [x for x in ((more, depth), (same, deeper), (less, depth)) if x[0]]
    for k in range(len(order)):
        if common[k] < 0:
            common[k] = _common(strings[order[k - 1]], strings[order[k]]) if k else 0
    return order, common


def equal_windows(left: list[bytes], right: list[bytes], groups: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of several anchors (``groups``: their counts), the earliest of
    an anchor first, as the reversed bytes before the anchor and the bytes from
    it on.  (context, o): the window that starts o bytes before the anchor of
    this context equals that of an earlier context of the same anchor."""
    n = len(left)
    sorted_by = []
    for strings in (left, right):
        rank, common, at = np.empty(n, np.int64), np.empty(n, np.int64), 0
        for size in groups.tolist():
            order, lcp = deep_shallow_sort(strings[at:at + size])
            lcp[0] = -1  # no prefix across anchors
            rank[at + np.array(order)] = np.arange(at, at + size)
            common[at:at + size] = lcp
            at += size
        sorted_by.append((rank, common))
    (rank_l, lcp_l), (rank_r, lcp_r) = sorted_by
    len_l, len_r = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    found_i, found_o = [], []
    for o in range(int(max(0, width - len_r.max())), int(len_l.max()) + 1):
        active = np.flatnonzero((len_l >= o) & (len_r >= width - o))
        if len(active) < 2:
            continue
        same_l = np.cumsum(lcp_l < o)[rank_l[active]]
        same_r = np.cumsum(lcp_r < width - o)[rank_r[active]]
        _, first, back = np.unique(same_l * (n + 1) + same_r, return_index=True, return_inverse=True)
        again = first[back] != np.arange(len(active))
        found_i.append(active[again])
        found_o.append(np.full(int(again.sum()), o))
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_o)


def _sort_suffixes(width: int) -> Callable:
    """Task: (anchor, doc_order, at, off, bytes) sorted by (anchor, doc_order, at) to spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            anchor = np.array([r[0] for r in rows], dtype=np.int64)
            new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            groups = np.diff(np.r_[new, len(rows)])
            left = [r[4][:r[3]][::-1] for r in rows]
            right = [r[4][r[3]:] for r in rows]
            i, o = equal_windows(left, right, groups, width)
            if len(i):
                order, at, off = (np.array([r[k] for r in rows], dtype=np.int64) for k in (1, 2, 3))
                got = _spans(order[i], at[i] + off[i] - o, np.full(len(i), width, dtype=np.int64))
                yield _rows(1, got[0], 0, got[0], got[1], got[2], 0)

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            if len(held) >= 40_000:
                cut = len(held) - 1
                while cut and held[cut][0] == held[cut - 1][0]:
                    cut -= 1
                if cut:
                    yield from solve(held[:cut])
                    held = held[cut:]
        if held:
            yield from solve(held)

    return run


def _deal_windows(width: int) -> Callable:
    """Task: contexts of very common anchors to their windows, keyed by the hash of their content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            key, order, at = [], [], []
            for _, o, a, _, body in zip(*(c.to_pylist() for c in batch.columns)):
                for w in range(len(body) - width + 1):
                    key.append(xxhash.xxh3_128_digest(body[w:w + width]))
                    order.append(o)
                    at.append(a + w)
            if key:
                both = np.frombuffer(b"".join(key), dtype=np.uint64).reshape(-1, 2)
                n = len(key)
                yield from _settle(both[:, 0].copy(), both[:, 1].copy(), np.array(order, dtype=np.int64), np.array(at, dtype=np.int64),
                                   np.full(n, width, dtype=np.int32), np.zeros(n, dtype=np.int32))

    return run


# ---------------------------------------------------------------- the operator

def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_order, at, size): spans to remove of ``docs`` (doc_order, tag, text);
    ``at`` holds the tag above 31 bits of position.  Spans may overlap."""
    order = ["kind", "anchor", "context", "doc_order", "at"]

    def compared(rows: DataFrame) -> DataFrame:
        return rows.repartition("kind", "anchor").sortWithinPartitions(*order).mapInArrow(_compare_contexts, _ROW)

    rows = docs.where(F.octet_length("text") >= width).mapInArrow(_anchor_rows(width, gram), _ROW)
    found = materialize(compared(rows), "contexts")
    asked = found.where("kind = 2").select("anchor", F.col("doc_order").alias("o"), "at", "size", "off")
    place = F.col("at").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    bodies = (docs.join(asked, (F.col("doc_order") == F.col("o")) & (F.col("tag") == F.shiftright("at", 31)))
              .select("anchor", "doc_order", "at", "off", F.substring(F.col("text").cast("binary"), place + 1, F.col("size")).alias("body")))
    spans = found.where("kind = 1")
    common = asked.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
    if not common.isEmpty():
        common = materialize(common.select("anchor"), "common-anchors")
        dealt = bodies.join(common, "anchor", "left_semi").select("anchor", "doc_order", "at", "off", "body")
        spans = spans.unionByName(compared(dealt.mapInArrow(_deal_windows(width), _ROW)).where("kind = 1"))
        bodies = bodies.join(common, "anchor", "left_anti").select("anchor", "doc_order", "at", "off", "body")
    by_anchor = bodies.repartition("anchor").sortWithinPartitions("anchor", "doc_order", "at")
    spans = spans.unionByName(by_anchor.mapInArrow(_sort_suffixes(width), _ROW))
    return spans.select("doc_order", "at", "size")


def cut_spans(text: str | None, starts, sizes) -> tuple[bytes, list[int], list[int]]:
    """What is left of the text's bytes, and the merged spans that go."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    begins: list[int] = []
    ends: list[int] = []
    for a, n in sorted(zip(starts, sizes)):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], a + n)
        else:
            begins.append(a)
            ends.append(a + n)
    edges = [0, *(x for pair in zip(begins, ends) for x in pair), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])), begins, ends


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM,
                   max_group: int = MAX_GROUP, names: tuple[str, str, str] = ("kept", "starts", "ends")) -> DataFrame:
    """``docs`` plus the kept bytes (binary) and the removed spans (starts, ends)."""
    order, tag, o, t, starts, sizes, cut = fresh(docs, "order", "tag", "o", "t", "starts", "sizes", "cut")
    number = F.coalesce(col(doc_id).cast("long"), F.lit(_LAST))
    mark = F.coalesce(F.crc32(col(text).cast("binary")), F.lit(0))
    rows = docs.select(number.alias("doc_order"), mark.alias("tag"), col(text).alias("text"))
    place = F.col("at").bitwiseAND(F.lit((1 << 31) - 1))
    spans = (repeated_spans(rows, width, gram, max_group)
             .groupBy(F.col("doc_order").alias(o), F.shiftright("at", 31).alias(t))
             .agg(F.collect_set(F.struct(place.alias("a"), F.col("size").cast("long").alias("n"))).alias("s"))
             .select(o, t, F.col("s.a").alias(starts), F.col("s.n").alias(sizes)))

    @F.pandas_udf("kept binary, starts array<long>, ends array<long>")
    def cutting(texts: pd.Series, a: pd.Series, n: pd.Series) -> pd.DataFrame:
        none: tuple = ()
        return pd.DataFrame([cut_spans(x, none if y is None else y, none if z is None else z) for x, y, z in zip(texts, a, n)],
                            columns=["kept", "starts", "ends"])

    held = docs.withColumn(order, number).withColumn(tag, mark)
    held = held.join(spans, (F.col(order) == F.col(o)) & (F.col(tag) == F.col(t)), "left")
    held = held.withColumn(cut, cutting(col(text), F.col(starts), F.col(sizes)))
    return held.select(*[col(c) for c in docs.columns], F.col(f"{cut}.kept").alias(names[0]),
                       F.col(f"{cut}.starts").alias(names[1]), F.col(f"{cut}.ends").alias(names[2]))
