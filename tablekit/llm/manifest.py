"""Merkle dataset manifest over nested intervals.

Each record is a leaf; per group, leaves in order of their id carry the
interval [rank, rank + 1).  A node covers the leaf ranks of its up to
``ARITY`` children, so a node's interval lies in those of all its ancestors,
and a node of level L starts at a multiple of ``ARITY ** L``.  Subroots of the
groups are the leaves of one more such tree, whose top is the root.

* Up: nodes of a level are grouped by the bucket of the level above (their
  start divided by its width) and hashed, until each group has one node.
* Down: nodes of a level join the level above on (group, bucket), containment
  of their interval as the condition; the parent hands on the siblings of its
  ancestors.  Siblings are the parent's interval less the node's own: the
  children that end before it starts, and those that start after it ends.

Ranks come from one distributed sort; a hot group is spread by its buckets
and never gathered.  Every level is written to the shared scratch folder and
has a third of the rows of the one below, texts are read once for the leaves
and not moved, and no table goes through the driver.

Defined results: a null field counts as ``-``; null ids come first in their
group; repeated ids are ordered by their leaf, identical rows stand side by
side; a null group is a group, the first; a lone leaf is its own subroot, a
lone subroot the root; proofs without siblings are the hash of nothing; rows
with a null id are not tampered with; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import col
from tablekit.plans.ranking import global_positions
from tablekit.session import materialize

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WRITE_EVERY = 3   # levels joined in one plan on the way down: few shuffles at once
STEP = "array<struct<left:string,right:string>>"


def field(c: Column) -> Column:
    """One field of a leaf: ``-``, or byte count, colon and value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def intervals(leaves: DataFrame, group: str, order: Sequence[Column], by: str) -> tuple[DataFrame, DataFrame]:
    """``leaves`` plus grp (the group's place among groups), lo, hi and n (leaves
    of the group); and the groups (``by``, grp, n)."""
    placed = global_positions(leaves, [F.col(group).asc_nulls_first(), *order], pos_col="position")
    groups = placed.groupBy(group).agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = global_positions(groups, [F.col("first").asc()], pos_col="place")
    groups = materialize(groups.select(F.col(group).alias(by), (F.col("place") - 1).alias("grp"), "first", "n"), "groups")
    lo = F.col("position") - F.col("first")
    ranked = (placed.join(groups, placed[group].eqNullSafe(groups[by]))
              .select(*[placed[c] for c in leaves.columns], "grp", "n", lo.alias("lo"), (lo + 1).alias("hi")))
    return materialize(ranked, "ranked"), groups


def grow(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The levels of the tree: leaves (grp, n, lo, hi, digest), then nodes with
    their ``kids`` too.  ``most`` is the number of leaves of the largest group."""
    levels = [leaves]
    width = 1
    while width < most:
        wide = width * ARITY
        kid = F.struct("lo", "hi", "digest")
        nodes = (levels[-1].where(F.col("n") > width).groupBy("grp", F.floor(F.col("lo") / wide).alias("bucket"))
                 .agg(F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                      F.array_sort(F.collect_list(kid)).alias("kids")))   # at most ARITY
        digest = F.sha2(F.array_join(F.col("kids")["digest"], ""), 256)
        levels.append(materialize(nodes.select("grp", "n", "lo", "hi", digest.alias("digest"), "kids"), "level"))
        width = wide
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(level, grp, lo, hi, digest, kids) of each group's one node that has no parent."""
    kids = "array<struct<lo:bigint,hi:bigint,digest:string>>"
    each = []
    for level, nodes in enumerate(levels):
        here = nodes.where(F.col("n") <= ARITY ** level)
        if level:
            here = here.where(F.col("n") > ARITY ** (level - 1))
        each.append(here.select(F.lit(level).alias("level"), "grp", "lo", "hi", "digest",
                                (F.col("kids") if level else F.lit(None)).cast(kids).alias("kids")))
    return materialize(reduce(DataFrame.unionByName, each), "tops")


def attach(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """The leaves plus ``path``: for each level up to the root the siblings'
    digests, joined, left and right of the node.  ``top`` holds the tops with
    the path above them."""
    held = None
    for level in reversed(range(len(levels))):
        nodes = levels[level]
        here = top.where(F.col("level") == level)
        own = nodes.columns
        if held is None:
            out = nodes.limit(0).withColumn("path", F.lit(None).cast(STEP))
        else:
            wide = ARITY ** (level + 1)
            parents = held.select(F.col("grp").alias("p_grp"), F.floor(F.col("lo") / wide).alias("p_bucket"),
                                  F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), "kids", F.col("path").alias("p_path"))
            inner = nodes.where(F.col("n") > ARITY ** level).select(*[F.col(c).alias(f"c_{c}") for c in own])
            met = inner.join(parents, (F.col("c_grp") == F.col("p_grp")) & (F.floor(F.col("c_lo") / wide) == F.col("p_bucket"))
                             & (F.col("p_lo") <= F.col("c_lo")) & (F.col("c_hi") <= F.col("p_hi")))
            side = lambda keep: F.array_join(F.filter("kids", keep)["digest"], "")
            step = F.struct(side(lambda k: k["hi"] <= F.col("c_lo")).alias("left"), side(lambda k: k["lo"] >= F.col("c_hi")).alias("right"))
            out = met.select(*[F.col(f"c_{c}").alias(c) for c in own], F.concat(F.array(step), "p_path").alias("path"))
        alone = nodes.where(F.col("n") <= ARITY ** level)
        if level:
            alone = alone.where(F.col("n") > ARITY ** (level - 1))
        alone = alone.join(here.select(F.col("grp").alias("t_grp"), "path"), F.col("grp") == F.col("t_grp")).drop("t_grp")
        held = out.unionByName(alone.select(*own, "path"))
        if level and level % WRITE_EVERY == 0:
            held = materialize(held, "paths")
    return held


def manifest(records: DataFrame, group: str, order: Sequence[str], carry: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """Of ``records`` with a column ``digest`` (the leaf): each record's order,
    ``carry``, digest, path, subroot and root; and the tree's levels, nodes with
    their intervals, ending with the levels over subroots."""
    names = dict.fromkeys([*order, *carry])
    leaves = records.select(col(group).alias("g_key"), *[col(c) for c in names], "digest",
                            F.monotonically_increasing_id().alias("row_id"))
    leaves = materialize(leaves, "leaves")
    ranked, groups = intervals(leaves, "g_key", [*[col(c).asc_nulls_first() for c in order], F.col("digest"), F.col("row_id")], "by")
    size, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    levels = grow(ranked, most or 0)
    top = tops(levels)
    subroots = materialize(top.select(F.lit(0).cast("long").alias("grp"), F.lit(size).cast("long").alias("n"),
                                      F.col("grp").alias("lo"), (F.col("grp") + 1).alias("hi"), "digest"), "subroots")
    upper = grow(subroots, size)
    root = tops(upper)
    heads = attach(upper, root.withColumn("path", F.array().cast(STEP)))
    # a subroot's path goes on above it; one row a group
    heads = materialize(heads.select(F.col("lo").alias("h_grp"), F.col("digest").alias("subroot"), "path"), "heads")
    seeds = top.join(heads, F.col("grp") == F.col("h_grp")).select("level", "grp", "lo", "hi", "digest", "kids", "path")
    paths = attach(levels, materialize(seeds, "seeds"))
    subs, last = heads.select("h_grp", "subroot"), root.select(F.col("digest").alias("root"))
    out = (paths.join(subs, F.col("grp") == F.col("h_grp"))
           .join(F.broadcast(last))          # one row
           .select(*[col(c) for c in names], "digest", "path", "subroot", "root"))
    return out, levels + upper


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof(path: Column) -> Column:
    """All siblings on the way to the root, left to right within a level."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def verify_documents(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Each document's leaf, subroot, root, path and proof, the root folded from
    its leaf after tampering (line feeds deleted from the text where 2 divides the
    CRC-32 of the id), and whether that is the root still."""
    columns = [col(c) for c in fields]
    odd = F.coalesce(F.pmod(F.crc32(col(doc_id).cast("string")), F.lit(2)) == 0, F.lit(False))
    changed = [F.translate(c, "\n", "") if name == text else c for name, c in zip(fields, columns)]
    hashed = docs.select(col(doc_id).alias("doc_id"), col(group).alias("g"), leaf(columns).alias("digest"),
                         F.when(odd & F.contains(col(text), F.lit("\n")), leaf(changed)).alias("altered"))
    found, _ = manifest(hashed, "g", ["doc_id"], ["altered"])
    folded = fold(F.coalesce("altered", "digest"), F.col("path"))
    out = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path",
                       F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
