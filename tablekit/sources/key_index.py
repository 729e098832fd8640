"""Key index beside a Parquet directory: which of its files may hold a key.

The index lies in the hidden folder ``_key_index`` of the directory, which
Spark's readers skip.  It consists of *generations*, one for each set of files
indexed at once, with two tables each:

* ``files``: name, length, time, and smallest and largest first key of a file;
* ``slots``: a blocked bit filter per file.  A key's hash gives its slot (a
  monotone share of the hash space) and one bit in each of ``WORDS`` words of
  it; a row holds the words of one (slot, file), built by ``bit_or``.

A probe joins keys to slots on the slot alone, so a key meets the files of its
slot only.  Rows written through ``spread_by_key`` lie in files by stretches of
the hash space: then that is about one file a generation.  Both sides of a
probe are hash-partitioned, neither passes the driver.  Past ``MAX_GENERATIONS``
the smaller generations are indexed again as one (they at least double, so a
key is read again a logarithmic number of times).

The index only ever leaves files out that cannot hold a key.  A file that is
not in it, or whose length or time changed (a crash between append and index,
another writer, a rewrite), counts as one that may; a generation whose
``slots`` are not complete, or made for other keys, is ignored.  One writer at a time.

The driver holds names of files (as Spark's own file index does) and one row a
generation.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import _hadoop, is_complete, path_exists, remove_path, type_path

WORDS = 8                 # bits a key sets, one in each 32-bit word of its slot
BITS_PER_KEY = 16         # so about one absent key in a thousand passes
ROWS_PER_FILE = 250_000
MAX_GENERATIONS = 8

FILE = ["file", "length", "at"]
SLOTS = "gen long, slot long, file string, " + ", ".join(f"w{i} int" for i in range(WORDS))
_SHARES = 31              # a slot is the share of the hash's upper 31 bits


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def _share(h: Column | str, parts: int) -> Column:
    """Which of ``parts`` equal stretches of the hash space a hash lies in."""
    return F.shiftright(F.shiftrightunsigned(h, 64 - _SHARES) * F.lit(parts).cast("long"), _SHARES)


def _words(h: str) -> list[Column]:
    """One bit in each word."""
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(WORDS)]


def _slots(n: int | None) -> int:
    """Slots of a generation of ``n`` keys."""
    return min(1 << _SHARES, max(1, math.ceil((n or 0) * BITS_PER_KEY / (32 * WORDS))))


def spread_by_key(rows: DataFrame, keys: Sequence[str], n_rows: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``rows`` (about ``n_rows``) partitioned by stretches of the hash space."""
    n = max(1, math.ceil(n_rows / rows_per_file))
    return rows.repartitionById(n, _share(_hash(keys, 1), n).cast("int"))


class KeyIndex:
    """The index of the directory ``path`` on ``keys``.  ``schema`` types the
    keys: an index made for other keys or types lies in another folder."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType,
                 max_generations: int = MAX_GENERATIONS):
        self.spark, self.path, self.keys, self.max_generations = spark, path.rstrip("/"), list(keys), max_generations
        signature = ",".join(f"{k}:{schema[k].dataType.simpleString()}" for k in self.keys)
        self.root = f"{self.path}/_key_index/{hashlib.sha256(signature.encode()).hexdigest()[:16]}"
        first = F.col(self.keys[0])
        # instants as numbers: a collected local time is ambiguous when clocks go back
        instant = isinstance(schema[self.keys[0]].dataType, T.TimestampType)
        self.first = F.unix_micros(first) if instant else first
        kind = "bigint" if instant else schema[self.keys[0]].dataType.simpleString()
        self.files_schema = f"gen long, file string, length long, at long, n long, lo {kind}, hi {kind}, nulls boolean"

    # ------------------------------------------------------------ what there is
    def listed(self) -> set[tuple[str, int, int]]:
        """Data files as they are now: name, length, time."""
        m = F.col("_metadata")
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                 .load(self.path).select(m["file_path"], m["file_size"], F.unix_micros(m["file_modification_time"])))
        return {tuple(r) for r in files.collect()}

    def read(self, files: Iterable[str]) -> DataFrame:
        """These files of the directory, with its partition columns."""
        return self.spark.read.option("basePath", self.path).parquet(*[unquote(f) for f in files])

    def generations(self) -> list[int]:
        """Complete generations."""
        if not path_exists(self.spark, self.root):
            return []
        p, fs = _hadoop(self.spark, self.root)
        found = [s.getPath().getName() for s in fs.globStatus(type_path(self.spark, p, "*")) or []]
        return sorted(int(g) for g in found if is_complete(self.spark, f"{self.root}/{g}/slots"))

    def _table(self, gens: Sequence[int], name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{g}/{name}" for g in gens])

    def indexed(self, gens: Sequence[int], listed: set[tuple[str, int, int]]) -> dict[int, dict[tuple[str, int, int], int]]:
        """Rows of each file that a generation holds and that is there unchanged."""
        out: dict[int, dict] = {g: {} for g in gens}
        for r in self._table(gens, "files", self.files_schema).select("gen", *FILE, "n").collect() if gens else []:
            if tuple(r)[1:4] in listed:
                out[r["gen"]][tuple(r)[1:4]] = r["n"]
        return out

    # ------------------------------------------------------------ probe
    def may_hold(self, batch: DataFrame) -> tuple[list[str], int]:
        """Files that may hold a key of ``batch``, and the number of files."""
        listed, gens = self.listed(), self.generations()
        known = {f for files in self.indexed(gens, listed).values() for f in files}
        names = {f for f, _, _ in known}
        hits = {r["file"] for r in self._hits(batch, gens).collect() if r["file"] in names} if known else set()
        return sorted(hits | {f for f, _, _ in listed - known}), len(listed)

    def _hits(self, batch: DataFrame, gens: Sequence[int]) -> DataFrame:
        """Indexed files that may hold a key: by the generation's range, the bits of
        the key's slot, then the file's own range."""
        files = self._table(gens, "files", self.files_schema)
        of_gen = files.groupBy("gen").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("nulls").alias("nulls"))

        def within(lo: Column, hi: Column, nulls: Column) -> Column:
            first = F.col("first")
            return F.coalesce(first.between(lo, hi), F.lit(False)) | (first.isNull() & F.coalesce(nulls, F.lit(False)))

        meets = [F.when(within(F.lit(g["lo"]).cast(files.schema["lo"].dataType), F.lit(g["hi"]).cast(files.schema["hi"].dataType),
                               F.lit(g["nulls"])),
                        F.struct(F.lit(g["gen"]).alias("gen"), _share("h", _slots(g["n"])).alias("slot")))
                 for g in of_gen.collect()]   # one row a generation
        hashed = batch.select(self.first.alias("first"), _hash(self.keys, 1).alias("h"), _hash(self.keys, 2).alias("bits"))
        keys = (hashed.select("first", *[w.alias(f"k{i}") for i, w in enumerate(_words("bits"))],
                              F.explode(F.array_compact(F.array(*meets))).alias("at")).select("*", "at.*").drop("at"))
        bits = reduce(lambda a, b: a & b, [F.col(f"k{i}").bitwiseAND(F.col(f"w{i}")) == F.col(f"k{i}") for i in range(WORDS)])
        held = keys.join(self._table(gens, "slots", SLOTS), ["gen", "slot"]).where(bits).select("gen", "file", "first")
        return (held.join(files, ["gen", "file"]).where(within(F.col("lo"), F.col("hi"), F.col("nulls")))
                .select("file").distinct())

    # ------------------------------------------------------------ upkeep
    def refresh(self) -> None:
        """Index the files that are not, then merge generations if there are many."""
        listed, gens = self.listed(), self.generations()
        known = self.indexed(gens, listed)
        fresh = listed - {f for files in known.values() for f in files}
        if fresh:
            self._index(fresh)
        if len(gens) + bool(fresh) <= self.max_generations:
            return
        known = self.indexed(self.generations(), listed)
        size = {g: sum(files.values()) for g, files in known.items()}
        few: list[int] = []
        for g in sorted(size, key=size.get):
            if len(few) > 1 and size[g] > 2 * sum(size[x] for x in few):   # over twice all smaller ones: left alone
                break
            few.append(g)
        stay = {f for g in known if g not in few for f in known[g]}
        again = {f for g in few for f in known[g]} - stay
        if again:
            self._index(again)
        for g in few:
            remove_path(self.spark, f"{self.root}/{g}")

    def _index(self, files: set[tuple[str, int, int]]) -> None:
        """Write one more generation, for ``files``."""
        gen = uuid.uuid4().int >> 65
        out = f"{self.root}/{gen}"
        rows = self.read(sorted(f for f, _, _ in files)).select(
            F.lit(gen).alias("gen"), F.col("_metadata.file_path").alias("file"), self.first.alias("first"),
            _hash(self.keys, 1).alias("h"), _hash(self.keys, 2).alias("bits"))
        held = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("lo"), F.max("first").alias("hi"),
                                        F.max(F.isnull("first")).alias("nulls"))
        # files without rows count as indexed too
        (self.spark.createDataFrame(sorted(files), "file string, length long, at long").join(held, "file", "left")
         .select(F.lit(gen).alias("gen"), *FILE, F.coalesce("n", F.lit(0)).cast("long").alias("n"), "lo", "hi", "nulls")
         .write.parquet(f"{out}/files"))
        n = self._table([gen], "files", self.files_schema).agg(F.sum("n")).first()[0]
        # written last: its marker makes the generation count
        (rows.select("gen", _share("h", _slots(n)).alias("slot"), "file", *[w.alias(f"w{i}") for i, w in enumerate(_words("bits"))])
         .groupBy("gen", "slot", "file").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
         .write.parquet(f"{out}/slots"))
