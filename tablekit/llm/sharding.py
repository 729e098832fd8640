"""Sharding by sampled splitters, so that every shard holds as many bytes.

Records are ordered by (hash of the text, hash of the id, row number), which
keeps copies of a text side by side.  A size-weighted sample of those keys is
drawn by a hash of the key, its quantiles cut the order into *ranges* of about
equal bytes, and records are partitioned by range.  A range that came out
overfull (in bytes or rows) is sampled again on its own and subdivided until
none is; the row number makes even a flood of identical rows divisible.  Exact
bytes and rows of each range then give every record its place in the whole
order, and equal stretches of that order are the shards.

A record above 1/``FINE`` of a shard could not be subdivided: such records
(fewer than ``FINE * shards`` by their size) are dealt first, the largest first
to the emptiest shard, and the stretches fill what is left.  So shards differ
by about 1/``FINE`` of a shard, unless one record alone is larger than a shard.

The driver holds the large records' keys, ``SAMPLES`` keys and two numbers a
range; a range stands for up to ``range_rows`` rows or ``range_bytes`` bytes.
Texts are written once with their keys and move once, to their range.

Defined results: a null text has no bytes and hashes like any value; null and
repeated ids, empty texts and repeated rows are records like any others; with
fewer records than shards some shards stay empty; extra columns are kept, but
one named like an output column is replaced; an empty table gives an empty
table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import col, fresh
from tablekit.session import materialize

SHARDS = 24
FINE = 32               # records above 1/FINE of a shard are dealt on their own
SAMPLES = 32            # keys drawn for each range
RANGE_ROWS = 1_000_000
RANGE_BYTES = 64 << 20
OVERFULL = 2            # times the intended bytes or rows

Key = tuple[int, int, int]


def ranges_of(splitters: list[Key], keys: list[np.ndarray]) -> np.ndarray:
    """The range of each key: how many splitters are not above it (a binary
    search over all keys at once, by the three parts in order)."""
    a, b, c = np.array(splitters, dtype=np.int64).reshape(-1, 3).T
    h, k, m = keys
    low, high = np.zeros(len(h), dtype=np.int64), np.full(len(h), len(a), dtype=np.int64)
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high) // 2, 0)
        above = (h > a[mid]) | ((h == a[mid]) & ((k > b[mid]) | ((k == b[mid]) & (m >= c[mid]))))
        low, high = np.where(open_ & above, mid + 1, low), np.where(open_ & ~above, mid, high)
    return low


def quantile_splitters(sample: list[tuple[Key, float]], parts: int) -> list[Key]:
    """Keys that cut the weighted sample into ``parts`` about equal parts."""
    sample = sorted(sample)
    total = np.cumsum([w for _, w in sample])
    if not len(total):
        return []
    at = np.searchsorted(total, total[-1] * np.arange(1, parts) / parts)
    return sorted({sample[i][0] for i in at})


def deal_large(sizes: list[int], shards: int) -> tuple[list[int], list[int]]:
    """Shard of each size (given largest first) and the bytes of each shard."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for size in sizes:
        load, s = heapq.heappop(heap)
        out.append(s)
        heapq.heappush(heap, (load + size, s))
    return out, [load for load, _ in sorted(heap, key=lambda x: x[1])]


def fill_levels(loads: list[int], rest: int) -> list[int]:
    """Twice the end of each shard's stretch of the remaining ``rest`` bytes,
    such that all shards that get any end at one level."""
    order = sorted(loads)
    n, held = 0, 0
    while n < len(order) and (n == 0 or order[n] * n - held < rest):
        held += order[n]
        n += 1
    ends, total = [], 0
    for load in loads:
        total += max(0, rest + held - n * load)  # n times the shard's stretch
        ends.append(2 * total // n)
    return ends


def _draw(keyed: DataFrame, names: list[str], chance: Column) -> list[tuple[Key, float]]:
    """Keys drawn with ``chance`` (above 1: surely, with that weight), by a hash of the key."""
    h, k, m = names
    u = F.pmod(F.xxhash64(F.lit("draw"), h, k, m), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = keyed.where(u < chance).select(h, k, m, F.greatest(chance, F.lit(1.0))).collect()
    return [((r[0], r[1], r[2]), r[3]) for r in rows]


def _split(keyed: DataFrame, names: list[str], size: str, n_rows: int, n_bytes: int, parts: int) -> tuple[list[Key], dict]:
    """Splitters without an overfull range, and (rows, bytes) of each range."""

    def counted(splitters: list[Key]) -> tuple[DataFrame, dict]:
        @F.pandas_udf("long")
        def place(h: pd.Series, k: pd.Series, m: pd.Series) -> pd.Series:
            return pd.Series(ranges_of(splitters, [x.to_numpy() for x in (h, k, m)]))

        with_range = keyed.select(*names, size, place(*names).alias("__range"))
        held = with_range.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).collect()
        return with_range, {r["__range"]: (r["n"], r["b"]) for r in held}

    splitters = quantile_splitters(_draw(keyed, names, F.col(size) * F.lit(SAMPLES * parts / n_bytes)), parts)
    with_range, held = counted(splitters)
    most_rows, most_bytes = OVERFULL * n_rows / parts, OVERFULL * n_bytes / parts
    while over := {r: max(n / most_rows, b / most_bytes) for r, (n, b) in held.items()
                   if n > 1 and (n > max(1, most_rows) or b > most_bytes)}:
        # each overfull range anew: by bytes and rows alike, as either may be too many
        share = F.create_map(*[F.lit(x) for r in over for x in (r, 2 * over[r] * SAMPLES)])[F.col("__range")]
        totals = F.create_map(*[F.lit(x) for r in over for x in (r, float(held[r][1]))])[F.col("__range")]
        rows = F.create_map(*[F.lit(x) for r in over for x in (r, float(held[r][0]))])[F.col("__range")]
        inside = with_range.where(F.col("__range").isin(list(over)))
        drawn = _draw(inside, names, share * (F.col(size) / totals + 1 / rows) / 2)
        places = ranges_of(splitters, [np.array([s[0][i] for s in drawn], dtype=np.int64) for i in range(3)])
        more = set(splitters)
        for r in over:
            more |= set(quantile_splitters([s for s, p in zip(drawn, places) if p == r], int(np.ceil(2 * over[r])) + 1))
        if len(more) == len(splitters):  # nothing drawn inside: any key halves it
            more |= {tuple(x) for x in inside.groupBy("__range").agg(F.max(F.struct(*names)).alias("x"))
                     .select("x.*").collect()}
        if len(more) == len(splitters):
            break
        splitters = sorted(more)
        with_range, held = counted(splitters)
    return splitters, held


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
                    out: tuple[str, str, str] = ("size", "shard", "slot"),
                    range_rows: int = RANGE_ROWS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` plus size (bytes of the text, plus 8), shard and slot (place in the shard)."""
    lost = {x.lower() for x in out}
    if {doc_id.lower(), text.lower()} & lost:
        raise ValueError(f"output columns {out} would replace {doc_id} or {text}")
    docs = docs.select(*[col(c) for c in docs.columns if c.lower() not in lost])
    h, k, m, size, place, before, row = fresh(docs, "text_hash", "id_hash", "row_id", "size", "range", "before", "row")
    keyed = materialize(docs.select(
        "*", F.xxhash64(col(text)).alias(h), F.xxhash64(col(doc_id)).alias(k),
        F.monotonically_increasing_id().alias(m),
        (F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long") + 8).alias(size)), "shard-keys")
    names = [h, k, m]
    n_rows, n_bytes = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    large = F.col(size) * (FINE * shards) > n_bytes
    few = sorted((-r[3], r[0], r[1], r[2]) for r in keyed.where(large).select(*names, size).collect())
    dealt, loads = deal_large([-r[0] for r in few], shards)
    taken = [0] * shards
    plan = []
    for r, s in zip(few, dealt):
        plan.append((*r[1:], s, taken[s]))
        taken[s] += 1
    chosen = keyed.sparkSession.createDataFrame(plan, "__h long, __k long, __m long, __shard int, __slot long")
    # at most FINE * shards rows, by their size
    big = keyed.where(large).join(F.broadcast(chosen), (col(h) == F.col("__h")) & (col(k) == F.col("__k")) & (col(m) == F.col("__m")))
    small = keyed.where(~large)
    rest_rows, rest = n_rows - len(few), n_bytes - sum(loads)
    parts = min(rest_rows, max(2 * shards, -(-rest_rows // range_rows), -(-rest // range_bytes)))
    splitters, held = _split(small, names, size, rest_rows, rest, parts) if rest_rows else ([], {})
    counts = np.array([held.get(r, (0, 0)) for r in range(len(splitters) + 1)], dtype=np.int64)
    row_before, bytes_before = (np.cumsum(counts, axis=0) - counts).T
    ends = np.array(fill_levels(loads, rest), dtype=np.int64)

    def shard_at(twice: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(ends, twice, side="right"), shards - 1)

    first_of = shard_at(2 * bytes_before)
    straddled = [int(r) for r in np.flatnonzero(first_of != shard_at(2 * (bytes_before + counts[:, 1]) - 1)) if counts[r, 0]]

    def placed(frame: DataFrame, firsts: np.ndarray, ranges: list[int] | None = None) -> DataFrame:
        """``frame`` with its range, shard and slot, given each shard's first rank."""
        @F.pandas_udf("long")
        def range_udf(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
            return pd.Series(ranges_of(splitters, [x.to_numpy() for x in (a, b, c)]))

        @F.pandas_udf("shard int, slot long")
        def place_udf(r: pd.Series, ahead: pd.Series, at: pd.Series, n: pd.Series) -> pd.DataFrame:
            r = r.to_numpy()
            shard = shard_at(2 * (bytes_before[r] + ahead.to_numpy()) + n.to_numpy())
            return pd.DataFrame({"shard": shard.astype(np.int32), "slot": row_before[r] + at.to_numpy() - 1 - firsts[shard]})

        frame = frame.withColumn(place, range_udf(*names))
        if ranges is not None:
            frame = frame.where(F.col(place).isin(ranges))
        w = Window.partitionBy(place).orderBy(*names)
        return (frame.withColumn(before, F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn(row, F.row_number().over(w).cast("long"))
                .withColumn(row, place_udf(place, before, row, size)))

    per_shard = np.zeros(shards, dtype=np.int64)
    np.add.at(per_shard, first_of, np.where(np.isin(np.arange(len(counts)), straddled), 0, counts[:, 0]))
    if straddled:
        cut = placed(small.select(*names, size), np.zeros(shards, dtype=np.int64), straddled)
        for s, n in cut.groupBy(F.col(row)["shard"]).agg(F.count(F.lit(1))).collect():
            per_shard[s] += n
    firsts = np.cumsum(per_shard) - per_shard - np.array(taken, dtype=np.int64)
    kept = [col(c) for c in docs.columns]
    return (placed(small, firsts)
            .select(*kept, col(size).alias(out[0]), F.col(row)["shard"].alias(out[1]), F.col(row)["slot"].alias(out[2]))
            .unionByName(big.select(*kept, col(size).alias(out[0]), F.col("__shard").alias(out[1]),
                                    F.col("__slot").alias(out[2]))))


def write_shards(sharded: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write the records as one folder a shard; files hold stretches in slot order."""
    sharded.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
