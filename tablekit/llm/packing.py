"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Method: large-item matching.  Pieces above one third of the capacity pair at
most twice per bin by greedy matching (longest first, with the longest large
partner that fits); smaller pieces, longest first, go best-fit into the
tightest gap that takes them, and open new bins only when no gap does.

Lengths are whole numbers up to the capacity, so the plan needs only how
often each length occurs.  Spark counts the lengths; the driver plans over
that histogram (at most ``capacity`` rows, whatever the corpus) in groups of
equal bins: each step uses up a length or a group, so the plan has a few
rows per length too.  Pieces find their place by (length, rank within the
length), joined to the plan; ranks come from counts per (input task, length)
and their running sums per length, so a length that a third of all pieces
share never meets in one task.

Defined results: a null text is an empty one; every document ends with token
id 0, so an empty text is one piece of one token; only documents longer than
the capacity are cut; repeated rows and null ids are packed like any others;
extra columns of the input are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.common import col
from tablekit.llm.wordcodes import codes_for
from tablekit.session import materialize

CAPACITY = 2048


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                     doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (binary,
    little-endian unsigned 32-bit), and (block, rank): the task that cut the
    piece and the piece's rank among the pieces of its length there."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("block", T.IntegerType()),
        T.StructField("rank", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, block = codes_for(tokenizer).encode, TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end, step = b"\0\0\0\0", 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, piece, start, ids, rank = [], [], [], [], []
                for i, value in enumerate(part.column(1)):
                    code = encode(value.as_py() or "") + end
                    for p, a in enumerate(range(0, len(code), step)):
                        row.append(i)
                        piece.append(p)
                        start.append(a // 4)
                        ids.append(code[a:a + step])
                        n = len(ids[-1]) // 4
                        rank.append(seen[n])
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()), pa.array([block] * len(row), pa.int32()),
                    pa.array(rank, pa.int64())], names=schema.names)

    return docs.select(col(doc_id), col(text)).mapInArrow(cut, schema)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """The packing plan of a length histogram: rows (length, first rank, end
    rank, first bin, per bin, offset).  The pieces of ``length`` with these
    ranks go ``per bin`` at a time into bins from ``first bin`` on, side by
    side from ``offset``."""
    left = {n: c for n, c in histogram.items() if c}
    rank = dict.fromkeys(left, 0)
    plan: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first bin, bins)]
    order: list[int] = []                          # gaps in use, ascending
    bins = 0

    def put(n: int, first: int, m: int, per: int, offset: int) -> None:
        plan.append((n, rank[n], rank[n] + m * per, first, per, offset))
        rank[n] += m * per
        left[n] -= m * per

    def keep(gap: int, first: int, m: int) -> None:
        if gap and m:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, m))

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            at = bisect_left(large, min(n, capacity - n) + 1) - 1
            while at >= 0 and not (left[large[at]] >= (2 if large[at] == n else 1)):
                at -= 1
            if at < 0:  # no large partner fits
                m, mate = left[n], 0
                put(n, bins, m, 1, 0)
            elif (mate := large[at]) == n:
                m = left[n] // 2
                put(n, bins, m, 2, 0)
            else:
                m = min(left[n], left[mate])
                put(n, bins, m, 1, 0)
                put(mate, bins, m, 1, n)
            keep(capacity - n - mate, bins, m)
            bins += m
    for n in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(order, n)
            if at == len(order):  # no gap takes it: open bins
                m = -(-left[n] // (capacity // n))
                keep(capacity, bins, m)
                bins += m
                continue
            gap = order[at]
            first, m = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            per = min(gap // n, left[n])
            used = min(m, left[n] // per)
            put(n, first, used, per, capacity - gap)
            keep(gap - per * n, first, used)
            keep(gap, first + used, m - used)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written, with length, block, rank) plus sequence_id and offset."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("block", "length", F.col("n"), (
        F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    before = materialize(before, "piece-counts")
    histogram = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_bins(histogram, capacity) or [(0, 0, 0, 0, 1, 0)],
                                 "p_length long, p_from long, p_to long, p_bin long, p_per long, p_offset long")
    ranked = (pieces.join(before.drop("n"), ["block", "length"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "block"))
    # the plan has a few rows per possible length, so its size is bounded by the capacity
    at = F.col("rank") - F.col("p_from")
    slot = F.pmod(at, F.col("p_per"))
    return (ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length"))
                        & (F.col("rank") >= F.col("p_from")) & (F.col("rank") < F.col("p_to")))
            .withColumn("sequence_id", F.col("p_bin") + ((at - slot) / F.col("p_per")).cast("long"))
            .withColumn("offset", F.col("p_offset") + slot * F.col("length"))
            .drop("rank", "p_length", "p_from", "p_to", "p_bin", "p_per", "p_offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32,
    sequence_id, offset.  Texts are tokenised once; the pieces are written to
    the shared scratch folder, and packing moves only their lengths."""
    cut = tokenized_pieces(docs, tokenizer, capacity, doc_id, text)
    pieces = materialize(cut.withColumn("ids_crc32", F.crc32("ids")), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids", "ids_crc32",
                                         "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed pieces joined into whole sequences."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.to_binary(F.lit(""), F.lit("hex")), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
