"""Graph jobs over an edge table.

Iterative: the driver loops over rounds, each round is a pair of joins and
one ``count`` action.  The edge table (read every round) and each round's
frontier / distance table are written as Parquet in the shared checkpoint
folder: lineage is cut, and a lost executor recomputes at most one round.
No round shuffles the edges.  A frontier of at most ``FRONTIER_ROWS`` is
broadcast; the first larger one has the edges written once more, in buckets by
source, and from then on large frontiers are shuffled to the buckets.  A hub
vertex with over ``BUCKET_EDGES`` edges has them dealt over several buckets,
and its row of a frontier goes to each of them.

A chain would cost one round a vertex.  A walk that is not over after
``SHORTCUT_AFTER`` rounds therefore goes on over a smaller graph: paths through
vertices with at most two neighbours (one-way or both ways) become one edge,
found by pointer doubling, in a number of joins that grows with the logarithm
of their length; dead ends go.  Doubling moves every vertex in every join, so
over ``THIN_OVER`` such vertices are thinned out first: about a third of those
left is spliced out per round, which moves a small multiple of the graph in
all.  Vertices inside get their distance from the ends at the last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, materialize_buckets

COMPACT_EVERY = 16  # rounds of frontiers kept as a union before folding them into one table
SHORTCUT_AFTER = 12  # rounds before paths become single edges
THIN_OVER = 100_000  # inner vertices left to pointer doubling
FRONTIER_ROWS = 100_000  # of a frontier that is broadcast
BUCKET_EDGES = 1_000_000  # edges a bucket; a vertex with more is dealt over several
MAX_BUCKETS = 100_000  # Spark's own limit
HUB_SLOTS = 65_536  # groups of vertices whose edges are counted to find those


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class _Arcs:
    """Edges ``e`` (_tk_s, _tk_d, _tk_w) that frontiers (_tk_v, ...) are joined with."""

    def __init__(self, e: DataFrame):
        self.e = e
        self.buckets: DataFrame | None = None

    def leaving(self, frontier: DataFrame, rows: int) -> DataFrame:
        """The ``rows`` rows of ``frontier`` with the edges that leave them."""
        if rows <= FRONTIER_ROWS:
            return self.e.join(F.broadcast(frontier), F.col("_tk_v") == F.col("_tk_s"))
        if self.buckets is None:
            self._lay_out()
        dealt = (frontier.join(F.broadcast(self.hubs), F.col("_tk_v") == F.col("_tk_h"), "left")
                 .withColumn("_tk_j", F.explode(F.expr("sequence(0, coalesce(_tk_n, 1) - 1)"))).drop("_tk_h", "_tk_n"))
        # the frontier is the side kept in memory, so the edges are not sorted either
        return (self.buckets.join(dealt.hint("shuffle_hash"), (F.col("_tk_s") == F.col("_tk_v")) & (F.col("_tk_k") == F.col("_tk_j")))
                .drop("_tk_k", "_tk_j"))

    def _lay_out(self) -> None:
        """Hubs are looked for only where a group of vertices has as many edges:
        counts of all sources would be about as many rows as there are edges."""
        e = self.e.withColumn("_tk_g", F.pmod(F.xxhash64("_tk_s"), F.lit(HUB_SLOTS)))
        many = F.col("count") > BUCKET_EDGES
        self.hubs = materialize(e.join(F.broadcast(e.groupBy("_tk_g").count().where(many)), "_tk_g", "left_semi")
                                 .groupBy("_tk_s").count().where(many)
                                 .select(F.col("_tk_s").alias("_tk_h"), F.ceil(F.col("count") / BUCKET_EDGES).cast("int").alias("_tk_n")), "graph_hubs")
        dealt = (self.e.join(F.broadcast(self.hubs), F.col("_tk_s") == F.col("_tk_h"), "left")
                 .select("_tk_s", "_tk_d", "_tk_w", F.expr("cast(coalesce(pmod(xxhash64(_tk_d), _tk_n), 0) as int)").alias("_tk_k")))
        n = max(int(self.e.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-self.e.count() // BUCKET_EDGES))
        self.buckets = materialize_buckets(dealt, "graph_buckets", min(n, MAX_BUCKETS), ("_tk_s", "_tk_k"))
        discard(self.e)
        self.e = self.buckets.drop("_tk_k")

    def discard(self) -> None:
        discard(self.e)
        discard(self.buckets)


def _thin(inner: DataFrame, outer: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Splices *inner* vertices out until at most ``THIN_OVER`` are left: the
    edges that take their place, with those of the vertices left, and one table
    (_tk_v, _tk_h, _tk_o) a round, for vertices of that round behind ones that
    stayed longer.

    ``inner`` has a vertex with its neighbours a and b (null: none), the
    weights to them (oa, ob) and from them (ba, bb); ``outer`` (_tk_v) are the
    other vertices.  In a round those go whose hash is greater than their inner
    neighbours', so no two neighbours go together and each that stays hears of
    at most two.  Two ways to one neighbour become one; a vertex then left with
    a way there and back of negative weight (a cycle) stays."""
    v, w = inner.schema["_tk_v"].dataType, inner.schema["oa"].dataType
    mark = lambda c: outer.select(F.col("_tk_v").alias(c), F.lit(True).alias(f"{c}x"))
    left = materialize(inner.join(mark("a"), "a", "left").join(mark("b"), "b", "left")
                       .select("_tk_v", *[x for c in "ab" for x in (c, f"o{c}", f"b{c}", F.col(f"{c}x").isNotNull().alias(f"{c}x"))]), "graph_thin")
    edges, places, n, rounds = [], [], left.count(), 0
    while n > THIN_OVER:
        rounds += 1
        rank = lambda c: F.xxhash64(F.col(c), F.lit(rounds))  # noqa: B023, E731
        goes = F.lit(True)
        for c in "ab":
            goes &= ((F.col(c).isNull() | F.col(f"{c}x") | (rank("_tk_v") > rank(c)))
                     & (F.coalesce(F.col(f"o{c}") + F.col(f"b{c}"), F.lit(0)) >= 0))
        gone, told = left.where(goes), []
        for c, d in ("ab", "ba"):
            out, back = (F.col(f"b{c}") + F.col(f"o{d}")).cast(w), (F.col(f"b{d}") + F.col(f"o{c}")).cast(w)
            linked = F.when(out.isNotNull() | back.isNotNull(), F.col(d))
            told.append(gone.where(F.col(c).isNotNull() & ~F.col(f"{c}x")).select(
                F.col(c).alias("_tk_v"), linked.alias("a"), out.alias("oa"), back.alias("ba"), F.col(f"{d}x").alias("ax"), F.col("_tk_v").alias("g")))
            edges.append(gone.where(F.col("ax") & F.col("bx") & out.isNotNull()).select(
                F.col(c).alias("_tk_s"), F.col(d).alias("_tk_d"), out.alias("_tk_w")))
        places.append(_union([gone.where(F.col(f"b{c}").isNotNull()).select("_tk_v", F.col(c).alias("_tk_h"), F.col(f"b{c}").alias("_tk_o")) for c in "ab"]))
        own = F.col("g").isNull()
        news = (left.where(~goes).withColumn("g", F.lit(None).cast(v)).unionByName(_union(told), allowMissingColumns=True)
                .repartition("_tk_v").groupBy("_tk_v")
                .agg(*[F.max(F.when(own, F.col(x))).alias(x) for c in "ab" for x in (c, f"o{c}", f"b{c}", f"{c}x")],
                     *[f("g").alias(f"g{i}") for i, f in enumerate((F.min, F.max))],
                     *[f(x, "g").alias(f"{x}{i}") for i, f in enumerate((F.min_by, F.max_by)) for x in ("a", "oa", "ba", "ax")]))
        heard = {x: F.when(F.col(c) == F.col("g0"), F.col(f"{y}0")).when(F.col(c) == F.col("g1"), F.col(f"{y}1")).otherwise(F.col(x))
                 for c in "ab" for x, y in ((c, "a"), (f"o{c}", "oa"), (f"b{c}", "ba"), (f"{c}x", "ax"))}
        news = news.select("_tk_v", *[F.coalesce(e, F.lit(False)).alias(x) if x.endswith("x") else e.alias(x) for x, e in heard.items()])
        twin = F.coalesce(F.col("a") == F.col("b"), F.lit(False))
        news = news.select("_tk_v", "a", *[F.when(twin, F.least(F.col(f"{x}a"), F.col(f"{x}b"))).otherwise(F.col(f"{x}a")).alias(f"{x}a") for x in "ob"], "ax",
                           *[F.when(~twin, F.col(x)).alias(x) for x in ("b", "ob", "bb")], (F.col("bx") & ~twin).alias("bx"))
        left = materialize(news, "graph_thin")
        before, n = n, left.count()
        if n * 16 > before * 15:   # nearly all that are left stay
            break
    for c in "ab":
        edges += [left.where(F.col(x).isNotNull()).select(F.col(s).alias("_tk_s"), F.col(d).alias("_tk_d"), F.col(x).alias("_tk_w"))
                  for s, d, x in (("_tk_v", c, f"o{c}"), (c, "_tk_v", f"b{c}"))]
    return _union(edges), places


def _shorten(e: DataFrame, ends: DataFrame) -> tuple[DataFrame, list[DataFrame], bool] | None:
    """Edges (_tk_s, _tk_d, _tk_w) with every path through *inner* vertices as
    one edge; tables (_tk_v, _tk_h, _tk_o): an inner vertex lies ``_tk_o``
    behind ``_tk_h`` (at most two rows a vertex), which is inner in no earlier
    table; whether a large part was inner, so that another call may pay.  None
    without inner vertices.

    A vertex is inner if it is none of ``ends`` (_tk_v), has at most two
    neighbours, no edge to itself, and no way to a neighbour and back of
    negative weight.  A least path never turns round at an inner vertex, so an
    edge that leaves one has a single predecessor: the edge from the other
    neighbour.  Each edge points to it, and pointers double until they meet
    an edge that leaves an outer vertex.  Edges without a predecessor, and
    those behind them, lie on no least path; rings of inner vertices are not
    reached from outside.  Both go.

    Only edges of *low* vertices are moved, if these are few: none of ``ends``,
    and neighbours in at most two of 16 hash classes, so every inner vertex is
    one.  The other edges are kept as they are."""
    w = e.schema["_tk_w"].dataType
    none = F.lit(None)
    e = e.where((F.col("_tk_s") != F.col("_tk_d")) | (F.col("_tk_w") < 0))   # a loop is no neighbour
    near = (e.select(F.col("_tk_s").alias("_tk_v"), F.col("_tk_d").alias("n"))
            .unionByName(e.select(F.col("_tk_d").alias("_tk_v"), F.col("_tk_s").alias("n"))))
    low = materialize(near.groupBy("_tk_v").agg(F.expr("bit_or(shiftleft(1, pmod(hash(n), 16)))").alias("m"))
                          .where("bit_count(m) <= 2").select("_tk_v").join(ends.distinct(), "_tk_v", "left_anti"), "graph_low")
    n_low = low.count()
    if not n_low:
        discard(low)
        return None
    rest, n_rest = [], 0
    if n_low <= FRONTIER_ROWS:
        of = lambda c: F.broadcast(low.select(F.col("_tk_v").alias(c), F.lit(True).alias(f"{c}_low")))
        split = materialize(e.join(of("_tk_s"), "_tk_s", "left").join(of("_tk_d"), "_tk_d", "left")
                             .select("_tk_s", "_tk_d", "_tk_w", F.coalesce("_tk_s_low", "_tk_d_low", F.lit(False)).alias("moved")), "graph_split", by=("moved",))
        rest, e = [split.where("not moved").drop("moved")], split.where("moved").drop("moved")
        n_rest = rest[0].count()
        ends = e.select(F.col("_tk_s").alias("_tk_v")).union(e.select("_tk_d")).join(F.broadcast(low), "_tk_v", "left_anti")
    arcs = materialize(e.groupBy("_tk_s", "_tk_d").agg(F.min("_tk_w").alias("_tk_w")), "graph_arcs")
    sides = (arcs.select(F.col("_tk_s").alias("_tk_v"), F.col("_tk_d").alias("n"), F.col("_tk_w").alias("out"), none.cast(w).alias("back"))
             .unionByName(arcs.select(F.col("_tk_d").alias("_tk_v"), F.col("_tk_s").alias("n"), none.cast(w).alias("out"), F.col("_tk_w").alias("back")))
             .groupBy("_tk_v", "n").agg(F.min("out").alias("out"), F.min("back").alias("back")))
    around = sides.groupBy("_tk_v").agg(
        F.count(F.lit(1)).alias("k"), F.min("n").alias("a"), F.max("n").alias("b"),
        F.min(F.col("out") + F.col("back")).alias("turn"), F.max(F.col("n") == F.col("_tk_v")).alias("loop"),
        *[f(x, "n").alias(f"{x[0]}{c}") for c, f in (("a", F.min_by), ("b", F.max_by)) for x in ("out", "back")])
    around = materialize(
        around.join(ends.select("_tk_v", F.lit(True).alias("end")).distinct(), "_tk_v", "left")
              .withColumn("inner", F.expr("k <= 2 and not loop and (turn is null or turn >= 0) and end is null"))
              .select("_tk_v", *[F.when(F.col("inner"), F.col(x)).alias(x) for x in ("a", "b", "oa", "ba", "ob", "bb")], "inner"),
        "graph_inner", by=("inner",))
    inner, outer = around.where("inner"), around.where("not inner").select("_tk_v")
    n_inner = inner.count()
    if not n_inner:
        discard(arcs)
        return None
    if n_inner > THIN_OVER:
        spliced, places = _thin(inner.select("_tk_v", "a", "oa", "ba", *[
            F.when(F.col("a") != F.col("b"), F.col(x)).alias(x) for x in ("b", "ob", "bb")]), outer)
        for c in ("_tk_s", "_tk_d"):
            arcs = arcs.join(outer.select(F.col("_tk_v").alias(c)), c, "left_semi")
        return materialize(_union([*rest, arcs.select("_tk_s", "_tk_d", "_tk_w"), spliced]), "graph_short"), places, True
    inner = inner.select("_tk_v", "a", "b")
    other = F.when(F.col("_tk_d") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    arcs_in = materialize(
        arcs.join(inner.select(F.col("_tk_v").alias("_tk_s"), "a", "b"), "_tk_s", "left")
            .join(inner.select(F.col("_tk_v").alias("_tk_d"), F.lit(True).alias("into")), "_tk_d", "left")
            .select("_tk_s", "_tk_d", F.col("_tk_w").alias("o"), F.col("a").isNotNull().alias("from_inner"),
                    F.col("into").isNotNull().alias("into"), F.when(other != F.col("_tk_d"), other).alias("p")), "graph_sides")
    v = arcs.schema["_tk_s"].dataType
    done = [arcs_in.where("not from_inner and into").select(
        "_tk_s", "_tk_d", "into", "o", F.col("_tk_s").alias("h"), none.cast(v).alias("ps"), none.cast(v).alias("pd"))]
    todo = arcs_in.where("p is not null").select(
        "_tk_s", "_tk_d", "into", "o", none.cast(v).alias("h"), F.col("p").alias("ps"), F.col("_tk_s").alias("pd"))
    before, left = None, todo.count()
    while left and left != before:           # as many as before: only rings are left
        known = _union([*done, todo]).select(*[F.col(c).alias(f"{c}2") for c in ("_tk_s", "_tk_d", "o", "h", "ps", "pd")])
        step = materialize(todo.join(known, (F.col("ps") == F.col("_tk_s2")) & (F.col("pd") == F.col("_tk_d2")))
                           .select("_tk_s", "_tk_d", "into", (F.col("o2") + F.col("o")).cast(w).alias("o"),
                                   F.col("h2").alias("h"), F.col("ps2").alias("ps"), F.col("pd2").alias("pd"),
                                   F.col("h2").isNotNull().alias("met")), "graph_pointers", by=("met",))
        done.append(step.where("met").drop("met"))
        todo = step.where("not met").drop("met")
        before, left = left, todo.count()
    found = _union(done)
    edges = materialize(_union([*rest, arcs_in.where("not from_inner and not into").select("_tk_s", "_tk_d", F.col("o").alias("_tk_w")),
                                found.where("not into").select(F.col("h").alias("_tk_s"), "_tk_d", F.col("o").alias("_tk_w"))]),
                        "graph_short")
    places = materialize(found.where("into").select(F.col("_tk_d").alias("_tk_v"), F.col("h").alias("_tk_h"), F.col("o").alias("_tk_o")),
                         "graph_places")
    return edges, [places], n_inner * 8 >= n_rest + arcs.count()


def _settle(e: DataFrame, parts: list[DataFrame], start: DataFrame, rounds: int, limit: int | None,
            at_most=None) -> tuple[DataFrame, bool]:
    """Least distances (_tk_v, _tk_o) over edges (_tk_s, _tk_d, _tk_w), and
    whether a negative cycle was met.  ``parts`` are the distances known after
    ``rounds`` rounds, the last one those of vertices not yet relaxed.  No
    improvement is left after ``limit`` rounds unless there is such a cycle.
    Distances over ``at_most`` are not followed."""
    def known() -> DataFrame:
        return _union(parts).groupBy("_tk_v").agg(F.min("_tk_o").alias("_tk_o"))

    def within(df: DataFrame, c: str) -> DataFrame:
        return df if at_most is None else df.where(F.col(c) <= at_most)

    places: list[DataFrame] = []
    arcs = _Arcs(e)
    due = SHORTCUT_AFTER
    negative = False
    rows = parts[-1].count()
    while True:
        if rounds >= due:
            due = 2 * rounds
            # vertices still to be relaxed stay: all others have handed on what is known of them
            more = True
            while more and (short := _shorten(arcs.e, start.unionByName(parts[-1].select("_tk_v")))):
                old, (e, at, more) = arcs, short
                arcs = _Arcs(e)
                old.discard()
                places += at
            if limit is not None and places:
                here = arcs.e.select("_tk_s").union(arcs.e.select("_tk_d")).distinct().count()
                limit = min(limit, rounds + here)   # the start may have no edge
        cand = within(arcs.leaving(parts[-1], rows)
                      .groupBy("_tk_d").agg(F.min(F.col("_tk_o") + F.col("_tk_w")).alias("_tk_n")), "_tk_n")
        improved = materialize(cand.join(known(), F.col("_tk_d") == F.col("_tk_v"), "left")
                               .where(F.col("_tk_o").isNull() | (F.col("_tk_n") < F.col("_tk_o")))
                               .select(F.col("_tk_d").alias("_tk_v"), F.col("_tk_n").alias("_tk_o")), "graph_improved")
        rows = improved.count()
        if not rows:
            discard(improved)
            break
        if limit is not None and rounds >= limit:
            negative = True
            break
        rounds += 1
        if rounds % COMPACT_EVERY == 0:
            old = parts
            parts = [materialize(known(), "graph_known")]
            for p in old:
                discard(p)
        parts.append(improved)
    for at in reversed(places):
        heads = known().select(F.col("_tk_v").alias("_tk_h"), F.col("_tk_o").alias("_tk_n"))
        behind = within(at.join(heads, "_tk_h").select("_tk_v", (F.col("_tk_n") + F.col("_tk_o")).alias("_tk_o")), "_tk_o")
        parts = [materialize(_union([known(), behind]).groupBy("_tk_v").agg(F.min("_tk_o").alias("_tk_o")), "graph_known")]
    return known(), negative


def bfs_levels(edges: DataFrame, src: str, dst: str, start, max_hops: int | None = None,
               vertex_col: str = "vertex", hop_col: str = "hops") -> DataFrame:
    """Vertices reachable from ``start`` (directed edges) with their hop
    distance; cycles end through the visited set (left anti join); stops
    on an empty frontier or after ``max_hops``.  A walk of over
    ``SHORTCUT_AFTER`` hops goes on over shortened paths."""
    spark = edges.sparkSession
    vtype = edges.schema[src].dataType
    # every round reads the edges: materialise them once as Parquet (a derived
    # edge table would otherwise be recomputed from its sources per round)
    e = materialize(edges.select(F.col(src).alias("_tk_s"), F.col(dst).alias("_tk_d"), F.lit(1).alias("_tk_w"))
                         .filter(F.col("_tk_s").isNotNull() & F.col("_tk_d").isNotNull()), "bfs_edges")
    first = spark.range(1).select(F.lit(start).cast(vtype).alias("_tk_v"), F.lit(0).alias("_tk_o"))
    parts, rows, arcs = [first], 1, _Arcs(e)
    hop = 0
    while max_hops is None or hop < max_hops:
        if hop >= SHORTCUT_AFTER:
            parts = [_settle(arcs.e, parts, first.select("_tk_v"), hop, None, max_hops)[0]]
            break
        hop += 1
        nxt = materialize(arcs.leaving(parts[-1], rows)
                          .select(F.col("_tk_d").alias("_tk_v")).distinct()
                          .join(_union(parts).select("_tk_v"), "_tk_v", "left_anti")
                          .withColumn("_tk_o", F.lit(hop)), "bfs_frontier")
        rows = nxt.count()
        if not rows:
            break
        parts.append(nxt)
    return _union(parts).select(F.col("_tk_v").alias(vertex_col), F.col("_tk_o").alias(hop_col))


def shortest_paths(edges: DataFrame, src: str, dst: str, weight: str, start,
                   vertex_col: str = "vertex", dist_col: str = "distance") -> DataFrame:
    """Least total weight from ``start`` to every vertex of the edge table
    (Bellman-Ford; negative weights allowed).  Only vertices improved in the
    previous round are relaxed (an edge without a weight is none), and a round writes only its improvements: the
    known distance of a vertex is the least over the improvements so far,
    folded into one table every ``COMPACT_EVERY`` rounds.  After
    ``SHORTCUT_AFTER`` rounds paths are shortened; the weights along one are
    then added in another order, so the last digits of fractions may differ.
    Unreachable vertices have NULL distance.  V-1 rounds settle every path, so
    an improvement after that means a reachable negative cycle, reported in the
    boolean column ``negative_cycle`` (distances then mean nothing)."""
    spark = edges.sparkSession
    vtype = edges.schema[src].dataType
    e = materialize(edges.select(F.col(src).alias("_tk_s"), F.col(dst).alias("_tk_d"),
                                 F.col(weight).cast("double").alias("_tk_w"))
                         .filter(F.col("_tk_s").isNotNull() & F.col("_tk_d").isNotNull()), "sp_edges")
    first = spark.range(1).select(F.lit(start).cast(vtype).alias("_tk_v"), F.lit(0.0).alias("_tk_o"))
    vertices = materialize(e.select(F.col("_tk_s").alias(vertex_col)).union(e.select("_tk_d"))
                            .union(first.select("_tk_v")).distinct(), "sp_vertices")
    limit = max(vertices.count() - 1, 0)
    known, negative = _settle(e.filter(F.col("_tk_w").isNotNull()), [materialize(first, "sp_dist")],
                              first.select("_tk_v"), 0, limit)
    return (vertices.join(known.select(F.col("_tk_v").alias(vertex_col), F.col("_tk_o").alias(dist_col)), vertex_col, "left")
                    .withColumn("negative_cycle", F.lit(negative)))
