import heapq
import json
import random
import re

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tablekit.functions.text import lcs_length, partial_ratio, token_sort_ratio
from tablekit.operators import graph as G
from tablekit.operators import jsonops as J
from tablekit.operators import text as TX


def _lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_lcs_bitparallel_matches_dp():
    rnd = random.Random(7)
    for _ in range(300):
        a = "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 15)))
        assert lcs_length(a, b) == _lcs_dp(a, b)


def test_partial_ratio_examples():
    assert partial_ratio("abc", "xxabcxx") == 100.0
    assert partial_ratio("", "abc") == 0.0
    assert 0 < partial_ratio("smll rng", "small ring") < 100


def test_fuzzy_match_against_brute_force(spark):
    ref = ["Lisboa", "Porto", "Braga", "Coimbra", "Faro"]
    dirty = ["Lisbo", "Prto", "Brga", "xyz", "", "Coimbr"]
    rdf = spark.createDataFrame([(r,) for r in ref], "name string")
    ddf = spark.createDataFrame([(d,) for d in dirty], "city string")
    got = {r.city: r.matched for r in TX.fuzzy_match(ddf, rdf, "city", "name", chunk_size=2).collect()}
    for d in dirty:
        best, score = None, -1
        for r in sorted(ref):          # ties: first in reference order (value order here)
            s = partial_ratio(d, r)
            if s > score:
                best, score = r, s
        expect = best.upper() if d and score >= 60 else ""
        assert got[d] == expect, (d, got[d], expect)
    q = TX.match_quality(ddf, rdf, "city", "name", chunk_size=2).first()
    assert q.matched_count == sum(v != "" for v in got.values())
    assert q.matched_count + q.unmatched_count == len(set(dirty))
    best = [max(token_sort_ratio(d, r) for r in ref) for d in dirty]
    assert abs(q.avg_score - sum(best) / len(best)) < 1e-9 and abs(q.max_score - max(best)) < 1e-9


def test_fuzzy_match_without_reference_keeps_every_value(spark):
    rdf = spark.createDataFrame([], "name string")
    ddf = spark.createDataFrame([("Lisbo",), (None,), ("",)], "city string")
    assert sorted(((r.city, r.matched, r.score) for r in TX.fuzzy_match(ddf, rdf, "city", "name").collect()), key=repr) == \
        sorted([("Lisbo", "", 0.0), (None, "", 0.0), ("", "", 0.0)], key=repr)
    assert TX.match_quality(ddf, rdf, "city", "name").first().unmatched_count == 3


def test_partial_ratio_scores_shorter_windows_at_both_ends():
    assert abs(partial_ratio("abcd", "cdxxxxx") - 200 * 2 / 6) < 1e-9
    assert abs(partial_ratio("xxxxxab", "abcd") - 200 * 2 / 6) < 1e-9


def test_clean_place_names(spark):
    df = spark.createDataFrame([("União das Freguesias de São-João",), (None,), ("  Vila  do Conde 2 ",)], "c string")
    out = [r.c_clean for r in TX.clean_place_names(df, "c").collect()]
    assert out[1] == "" and out[2] == "Vila Conde"
    assert out[0] == "Sao Joao"


def test_strip_control_chars(spark):
    df = spark.createDataFrame([(" a\x00b\nc\x85d� ",)], "t string")
    assert TX.strip_control_chars(df, "t").first().t == "abcd"


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "good good bad"), (2, "nothing here"), (3, "bad")], "id long, t string")
    lex = spark.createDataFrame([("good", 0.5), ("bad", -0.5)], "word string, polarity double")
    out = {r.id: r.sentiment for r in TX.sentiment_label(df, "t", lex).collect()}
    assert out == {1: "positive", 2: "neutral", 3: "negative"}


SHIPS = [
    {"hull": 7, "class": "cutter", "yard": {"port": "Aveiro", "dock": "north"}, "masts": ["main", "mizzen"]},
    {"hull": 8, "class": "sloop", "yard": {"port": "Viana", "dock": "south", "crane": "K2"}},
    {"hull": "9b", "class": "ketch"},
]


def test_json_inference_and_tables(spark):
    df = spark.createDataFrame([(json.dumps(p),) for p in SHIPS], "payload string")
    cols = {r.path: (r.sql_type, r.conflict) for r in J.infer_json_columns(df, "payload").collect()}
    assert cols["hull"] == ("VARCHAR(255)", True)          # INT against text widens
    assert cols["yard.crane"][0] == "VARCHAR(255)"
    assert cols["masts[]"][0] == "VARCHAR(255)"
    tabs = J.json_to_tables(df, "payload")
    assert set(tabs) == {(), ("yard",), ("masts",)}
    assert set(tabs[("yard",)].columns) == {"root_id", "port", "dock", "crane"}   # union of fields
    assert tabs[("masts",)].count() == 2 and tabs[()].count() == 3


def test_json_tables_lose_nothing(spark):
    docs = [{"a": {"items": [1]}, "b": {"items": [2]}, "root": {"x": 1}, "p.q": 5, "m": [[1, 2], [3]],
             "o": [{"in": [{"z": 1}, {"z": 2}]}, {"in": []}], "OBJECT<": 3, "n": 1, "N": 2, "pos_1": 4},
            {"n": {"deep": True}, "m": []}]
    df = spark.createDataFrame([(str(i), json.dumps(d)) for i, d in enumerate(docs)], "k string, payload string")
    tabs = J.json_to_tables(df, "payload", key_col="k")
    assert rows(tabs[("a", "items")], "value") == [(1,)] and rows(tabs[("b", "items")], "value") == [(2,)]
    assert rows(tabs[("root",)], "x") == [(1,)]
    assert rows(tabs[("m", None)]) == [("0", 0, 0, 1), ("0", 0, 1, 2), ("0", 1, 0, 3)]
    assert rows(tabs[("o", "in")]) == [("0", 0, 0, 1), ("0", 0, 1, 2)]
    first = [r for r in tabs[()].collect() if r["k"] == "0"][0].asDict()
    assert first["p.q"] == 5 and first["OBJECT<"] == 3 and first["pos_1"] == 4 and {str(first["N"]), str(first["n_2"])} == {"1", "2"}
    second = [r for r in tabs[()].collect() if r["k"] == "1"][0].asDict()
    assert second["n_2"] == '{"deep":true}'                # a type conflict keeps the object as its JSON


def test_json_flatten_outer(spark):
    docs = [{"order_id": 1, "customer": {"id": 10}, "items": [{"product_id": 1, "price": 10}]},
            {"order_id": 2, "customer": {"id": 11}, "items": []}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    spec = dict(parent_paths={"order_id": "order_id", "customer_id": "customer.id"}, array_path="items",
                item_paths={"product_id": "product_id", "price": "price"})
    assert rows(J.json_flatten(df, "payload", **spec)) == [("1", "10", "1", "10")]
    assert J.json_flatten(df, "payload", outer=True, **spec).count() == 2


def test_bfs_cycle(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "s long, d long")
    assert rows(G.bfs_levels(e, "s", "d", 1), "vertex", "hops") == [(1, 0), (2, 1), (3, 2), (4, 3)]


ROADS = {"p": {"q": 7, "r": 2}, "r": {"q": 3, "s": 9, "t": 4}, "q": {"s": 2}, "t": {"s": 1, "u": 6}, "v": {"p": 1}}


def test_shortest_paths_literal_graph(spark):
    e = spark.createDataFrame([(a, b, float(w)) for a, nb in ROADS.items() for b, w in nb.items()],
                              "s string, d string, w double")
    got = {r.vertex: r.distance for r in G.shortest_paths(e, "s", "d", "w", "p").collect()}
    assert got == {"p": 0.0, "r": 2.0, "q": 5.0, "t": 6.0, "s": 7.0, "u": 12.0, "v": None}


def test_shortest_paths_long_chain_is_no_cycle(spark):
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(40)], "s long, d long, w double")
    got = G.shortest_paths(e, "s", "d", "w", 0).collect()
    assert {r.vertex: r.distance for r in got} == {i: float(i) for i in range(41)}
    assert not any(r.negative_cycle for r in got)


def test_shortest_paths_negative_cycle(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, -2.0), (3, 2, 1.0)], "s long, d long, w double")
    assert G.shortest_paths(e, "s", "d", "w", 1).first().negative_cycle is True


def test_shortest_paths_brute_force_on_fixture(spark):
    from tablekit.plans.bindings import part_supplier_edges
    e = part_supplier_edges(spark, SF_SMALL)
    adj = {}
    for r in e.collect():
        adj.setdefault(r.src, []).append((r.dst, r.w))
    dist, heap = {0: 0.0}, [(0.0, 0)]
    while heap:
        d, v = heapq.heappop(heap)
        if d > dist.get(v, float("inf")):
            continue
        for u, w in adj.get(v, []):
            if d + w < dist.get(u, float("inf")):
                dist[u] = d + w
                heapq.heappush(heap, (d + w, u))
    got = {r.vertex: r.distance for r in G.shortest_paths(e, "src", "dst", "w", 0).collect()}
    assert {k: v for k, v in got.items() if v is not None} == dist


def test_upper_bound_never_below_score():
    import random
    from tablekit.functions.text import ratio_upper_bound
    rnd = random.Random(11)
    for _ in range(500):
        a = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 10)))
        b = "".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 20)))
        assert ratio_upper_bound(a, b, {}) >= partial_ratio(a, b) - 1e-9


def test_sentiment_does_not_mix_rows_of_one_id(spark):
    df = spark.createDataFrame([(1, "good"), (1, "bad"), (None, "good"), (None, None), (2, "")], "id long, t string")
    lex = spark.createDataFrame([("good", 0.5), ("bad", -0.5), ("bad", -0.25)], "word string, polarity double")
    got = rows(TX.sentiment_label(df, "t", lex), "id", "t", "polarity", "sentiment")
    assert got == sorted([(1, "good", 0.5, "positive"), (1, "bad", -0.375, "negative"), (None, "good", 0.5, "positive"),
                          (None, None, 0.0, "neutral"), (2, "", 0.0, "neutral")], key=repr)


def test_json_to_tables_top_level_array(spark):
    df = spark.createDataFrame([("doc1", json.dumps(SHIPS[:2]))], "k string, payload string")
    tabs = J.json_to_tables(df, "payload", key_col="k")
    assert rows(tabs[()], "k", "hull", "class") == [("doc1:0", 7, "cutter"), ("doc1:1", 8, "sloop")]
    assert rows(tabs[("masts",)], "root_id", "value") == [("doc1:0", "main"), ("doc1:0", "mizzen")]
    assert tabs[("yard",)].count() == 2


def test_bfs_long_chain_compacts_visited(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)], "s long, d long")
    got = rows(G.bfs_levels(e, "s", "d", 0), "vertex", "hops")
    assert got == sorted([(i, i) for i in range(41)], key=repr)


def test_names_that_are_data_become_rows(spark):
    """Ids as field names, also inside each other and inside arrays; numbers keep
    their digits, names with quotes are told apart."""
    docs, want, deep = [], [], []
    for d in range(60):
        m = {f"id{d}_{i}": {"n": i, "tags": {f"t{d}-{i}-{j}": j for j in range(2)}} for i in range(3)}
        docs.append((d, json.dumps({"name": f"d{d}", "m": m, "list": [{"x": {f'q"{d}': d}}], "big": 12345678901234567890123456})))
        want += [(d, k, v["n"]) for k, v in m.items()]
        deep += [(d, t, j) for v in m.values() for t, j in v["tags"].items()]
    docs += [(100, None), (101, "no json"), (102, "{}"), (103, '{"m": {}, "list": []}')]
    df = spark.createDataFrame(docs, "k int, p string")
    assert J.data_like_objects(df, "p", 50) == {(".m",), (".m", "{}", ".tags"), (".list", "[]", ".x")}
    assert J.data_like_objects(df, "p", 1000) == set()   # `close` looks at every path, and finds none
    tabs = J.json_to_tables(df, "p", key_col="k", max_fields=50)
    assert rows(tabs[("m",)], "root_id", "key") == sorted(((d, k) for d, k, _ in want), key=repr)
    assert rows(tabs[("m", "value")], "root_id", "n") == sorted(((d, n) for d, _, n in want), key=repr)
    assert rows(tabs[("m", "value", "tags")], "root_id", "key", "value") == sorted(deep, key=repr)
    assert rows(tabs[("list", "x")], "root_id", "key", "value") == sorted(((d, f'q"{d}', d) for d in range(60)), key=repr)
    assert tabs[()].filter("k < 60 and name = concat('d', k)").count() == 60
    inferred = {r["path"]: (r["kinds"], r["n_values"]) for r in J.infer_json_columns(df, "p", max_fields=50).collect()}
    assert inferred["m[].value.n"] == ("int", 180) and inferred["m[].value.tags[].key"] == ("text", 360)
    assert inferred["list[].x[].value"] == ("int", 60) and inferred["m"] == ("array", 61) and len(inferred) < 20


def test_a_million_names_stay_off_the_driver(spark):
    df = spark.range(250_000).select(F.concat(*[x for i in range(4) for x in (
        F.lit('{"m":{"' if i == 0 else '"'), F.col("id") * 4 + i, F.lit('":'), F.col("id") + i, F.lit("," if i < 3 else "}}"))]).alias("p"))
    tabs = J.json_to_tables(df, "p")
    assert set(tabs) == {(), ("m",)}
    got = tabs[("m",)].select(F.col("key").cast("long").alias("k"), "value")
    assert got.agg(F.count("k"), F.sum("k"), F.sum("value"), F.min("k"), F.max("k")).first() == (
        1_000_000, sum(range(1_000_000)), sum(4 * i + 6 for i in range(250_000)), 0, 999_999)


def least(arcs, start, vertices):
    """Plain Bellman-Ford on a list of (source, target, weight); None: a negative cycle."""
    dist = {start: 0}
    for _ in range(len(vertices) + 1):
        better = False
        for s, d, w in arcs:
            if w is not None and s in dist and dist[s] + w < dist.get(d, float("inf")):
                dist[d] = dist[s] + w
                better = True
        if not better:
            return dist
    return None


@pytest.mark.parametrize("both_ways", [False, True])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, both_ways):
    """10,000 vertices in an order that is not theirs, with a twig at every tenth."""
    rounds = []
    real = G.materialize
    monkeypatch.setattr(G, "materialize", lambda df, name, **by: rounds.append(name) or real(df, name, **by))
    n = 10_000
    at = F.col("id") * 7919 % 10_007
    e = spark.range(n - 1).select(at.alias("s"), ((F.col("id") + 1) * 7919 % 10_007).alias("d"), (F.col("id") % 5 + 1).cast("double").alias("w"))
    e = e.unionByName(spark.range(0, n, 10).select(at.alias("s"), (F.col("id") + 20_000).alias("d"), F.lit(0.5).alias("w")))
    if both_ways:
        e = e.unionByName(e.select(F.col("d").alias("s"), F.col("s").alias("d"), "w"))
    got = {r.vertex: r.distance for r in G.shortest_paths(e, "s", "d", "w", 0).collect()}
    want, d = {}, 0.0
    for i in range(n):
        want[i * 7919 % 10_007] = d
        if i % 10 == 0:
            want[20_000 + i] = d + 0.5
        d += i % 5 + 1
    assert got == want
    assert sum(r in ("graph_improved", "graph_pointers") for r in rounds) < 40
    if not both_ways:
        return
    rounds.clear()
    hops = {r.vertex: r.hops for r in G.bfs_levels(e, "s", "d", 0).collect()}
    assert hops == {**{i * 7919 % 10_007: i for i in range(n)}, **{20_000 + i: i + 1 for i in range(0, n, 10)}}
    assert sum(r in ("bfs_frontier", "graph_improved", "graph_pointers") for r in rounds) < 40
    assert G.bfs_levels(e, "s", "d", 0, max_hops=5_000).agg(F.max("hops"), F.count("*")).first() == (5_000, 5_001 + 500)


@pytest.mark.parametrize("seed", range(3))
def test_shortened_paths_equal_brute_force(spark, monkeypatch, seed):
    """Sparse graphs with chains, rings, dead ends, twins, loops to themselves and
    negative weights; shortened from the first or second round on."""
    rnd = random.Random(seed)
    monkeypatch.setattr(G, "SHORTCUT_AFTER", seed % 3)
    n = 60
    arcs = []
    for i in range(1, n):
        j = i - 1 if rnd.random() < 0.8 else rnd.randrange(n)
        arcs.append((j, i, rnd.randint(1, 9)))
        if rnd.random() < 0.6:
            arcs.append((i, j, rnd.randint(1, 9)))
    for _ in range(seed):
        arcs.append((rnd.randrange(n), rnd.randrange(n), rnd.choice([None, 0, 3, 8])))
    arcs += [(100 + i, 100 + (i + 1) % 5, 1) for i in range(5)] + [(rnd.randrange(n), 200, 4), (7, 7, 0)]
    pot = {v: rnd.randint(0, 6) for v in [*range(n), *range(100, 105), 200]} if seed % 2 else {}
    arcs = [(s, d, w if w is None else w + pot.get(s, 0) - pot.get(d, 0)) for s, d, w in arcs]  # negative, but no such cycle
    vertices = {x for s, d, _ in arcs for x in (s, d)} | {0}
    e = spark.createDataFrame([(s, d, None if w is None else float(w)) for s, d, w in arcs], "s long, d long, w double")
    got = G.shortest_paths(e, "s", "d", "w", 0).collect()
    want = least(arcs, 0, vertices)
    assert {r.vertex: r.distance for r in got} == {v: want.get(v) for v in vertices}
    assert not any(r.negative_cycle for r in got)
    hops = {r.vertex: r.hops for r in G.bfs_levels(e, "s", "d", 0).collect()}
    assert hops == least([(s, d, 1) for s, d, _ in arcs], 0, vertices)
    assert {v for v, h in hops.items() if h <= 7} == {r.vertex for r in G.bfs_levels(e, "s", "d", 0, max_hops=7).collect()}


def test_a_chain_is_thinned_before_pointers_double(spark, monkeypatch):
    """Rows moved in all are a small multiple of the vertices, whatever the length (doubling alone: 16,000 pointers)."""
    moved = []
    real = G.materialize

    def counted(df, name, **by):
        out = real(df, name, **by)
        moved.append(out.count() if name in ("graph_thin", "graph_pointers") else 0)
        return out

    monkeypatch.setattr(G, "materialize", counted)
    monkeypatch.setattr(G, "THIN_OVER", 100, raising=False)
    n = 1_000
    at = F.col("id") * 7919 % 1_009
    e = spark.range(n - 1).select(at.alias("s"), ((F.col("id") + 1) * 7919 % 1_009).alias("d"), (F.col("id") % 5 + 1).cast("double").alias("w"))
    e = e.unionByName(e.select(F.col("d").alias("s"), F.col("s").alias("d"), (F.col("w") + 1).alias("w")))
    got = {r.vertex: r.distance for r in G.shortest_paths(e, "s", "d", "w", 0).collect()}
    assert got == {i * 7919 % 1_009: sum(j % 5 + 1 for j in range(i)) for i in range(n)}
    assert sum(moved) < 6 * n


def test_thinned_graphs_equal_brute_force(spark, monkeypatch):
    """Forty sparse graphs as in the test above, side by side, thinned until no inner vertex is left."""
    monkeypatch.setattr(G, "SHORTCUT_AFTER", 1)
    monkeypatch.setattr(G, "THIN_OVER", 0, raising=False)
    arcs = []
    for seed in range(40):
        rnd, n, k = random.Random(seed), 40, 1_000 * (seed + 1)
        own = [(j := i - 1 if rnd.random() < 0.85 else rnd.randrange(i), i, rnd.randint(1, 9)) for i in range(1, n)]
        own += [(d, s, rnd.randint(1, 9)) for s, d, _ in own if rnd.random() < 0.6]
        own += [(rnd.randrange(n), rnd.randrange(n), rnd.choice([None, 0, 3, 8])) for _ in range(seed % 4)]
        own += [(100 + i, 100 + (i + 1) % 5, 1) for i in range(5)] + [(7, 7, 0), (n - 1, 50, 3), (50, 51, 2), (51, n - 1, 1), (51, 50, 5)]
        pot = [rnd.randint(0, 6) * (seed % 2) for _ in range(200)]   # negative weights, but no such cycle
        arcs += [(k + s, k + d, w if w is None else w + pot[s] - pot[d]) for s, d, w in own] + [(0, k, 1)]
    vertices = {x for s, d, _ in arcs for x in (s, d)}
    e = spark.createDataFrame([(s, d, None if w is None else float(w)) for s, d, w in arcs], "s long, d long, w double")
    got = G.shortest_paths(e, "s", "d", "w", 0).collect()
    want = least(arcs, 0, vertices)
    assert {r.vertex: r.distance for r in got} == {v: want.get(v) for v in vertices}
    assert not any(r.negative_cycle for r in got)
    hops = {r.vertex: r.hops for r in G.bfs_levels(e, "s", "d", 0).collect()}
    assert hops == least([(s, d, 1) for s, d, _ in arcs], 0, vertices)


@pytest.mark.parametrize("weight", [-9.0, -4.0])
def test_a_ring_at_one_vertex_is_seen_when_thinned(spark, monkeypatch, weight):
    monkeypatch.setattr(G, "THIN_OVER", 0, raising=False)
    arcs = [(i, i + 1, 1.0) for i in range(20)] + [(20, 30, 2.0), (30, 31, 2.0), (31, 32, weight), (32, 20, 1.0)]
    arcs += [(30, 20, 9.0), (31, 30, 9.0), (20, 32, 9.0)]
    got = G.shortest_paths(spark.createDataFrame(arcs, "s long, d long, w double"), "s", "d", "w", 0).collect()
    assert {r.negative_cycle for r in got} == {weight == -9.0}
    if weight == -4.0:
        assert {r.vertex: r.distance for r in got} == least(arcs, 0, {x for s, d, _ in arcs for x in (s, d)})


@pytest.mark.parametrize("cycle", [[(30, 31, 2.0), (31, 30, -3.0)], [(30, 3, -28.0)], [(30, 30, -1.0)]])
def test_negative_cycle_behind_a_long_chain(spark, cycle):
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(30)] + cycle, "s long, d long, w double")
    assert G.shortest_paths(e, "s", "d", "w", 0).first().negative_cycle is True


def test_data_keys_are_not_gathered_to_broadcast(spark, capsys):
    from tablekit.plans.bindings import BINDINGS
    BINDINGS["json_data_keys"](spark, SF_SMALL).explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_documents_are_made_once_and_kinds_follow_merged_types(spark):
    """Whole numbers among fractions, also in arrays in arrays; nulls; conflicts."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def document(k):
        made.add(1)
        return json.dumps({"whole": k, "part": k / 2 if k % 3 else k, "half": k + 0.5, "none": None, "gone": {"x": None},
                           "big": 10 ** 20 + k, "on": k % 2 == 0 if k else None, "any": [k, "t", [k]][k % 3],
                           "m": [[{"a.b": 1.5, "c": [0.5, k]}, None], []], "n": [[1, 2], [None]]})

    df = spark.range(30).select(F.col("id").alias("k"), document("id").alias("p"))
    tabs = J.json_to_tables(df, "p", key_col="k")
    assert made.value == 30
    assert dict(tabs[()].dtypes) == {"k": "bigint", "whole": "bigint", "part": "string", "half": "double", "none": "string",
                                     "big": "double", "on": "boolean", "any": "string"}
    assert dict(tabs[("gone",)].dtypes)["x"] == "string" and dict(tabs[("n", None)].dtypes)["value"] == "bigint"
    assert dict(tabs[("m", None)].dtypes)["a.b"] == "double" and dict(tabs[("m", None, "c")].dtypes)["value"] == "string"
    assert tabs[("m", None, "c")].filter("pos_1 = 0 and pos_2 = 0").groupBy("value").count().count() == 31
    got = {r.path: (r.kinds, r.sql_type, r.n_values) for r in J.infer_json_columns(df, "p").collect()}
    assert made.value == 60
    assert got["part"] == ("float,int", "VARCHAR(255)", 30) and got["on"] == ("boolean", "BOOLEAN", 30)
    assert got["gone.x"] == ("", "VARCHAR(255)", 30) and got["big"] == ("float", "FLOAT", 30)
    assert got["any"] == ("array,int,text", "VARCHAR(255)", 30) and got["m[][]"] == ("object", "OBJECT", 60)
    assert got["m[][].c[]"] == ("float,int", "VARCHAR(255)", 60) and got["n[][]"] == ("int", "INT", 90)


def test_small_lexicon_moves_no_words(spark, monkeypatch, capsys):
    from tablekit.plans.bindings import BINDINGS
    df = BINDINGS["sentiment_label"](spark, SF_SMALL)
    df.explain()
    by_word = r"hashpartitioning\([^)]*_tk_w"
    assert not re.search(by_word, capsys.readouterr().out)
    monkeypatch.setattr(TX, "BROADCAST_WORDS", 0)
    shuffled = BINDINGS["sentiment_label"](spark, SF_SMALL)
    shuffled.explain()
    assert re.search(by_word, capsys.readouterr().out)
    assert rows(df) == rows(shuffled)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_round_shuffles_the_edges(spark, monkeypatch):
    """Frontiers too large to broadcast go to the edges, which are dealt out once."""
    made = []
    real = G.materialize
    monkeypatch.setattr(G, "materialize", lambda df, name, **by: made.append((name, plan(df))) or real(df, name, **by))
    monkeypatch.setattr(G, "FRONTIER_ROWS", 5, raising=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rnd = random.Random(5)
        arcs = [(rnd.randrange(300), 1_000 + rnd.randrange(40), rnd.randint(1, 50)) for _ in range(3_000)]
        arcs += [(d, s, w) for s, d, w in arcs] + [(0, 1_000, 3), (0, 0, 1)]
        e = spark.createDataFrame([(s, d, float(w)) for s, d, w in arcs], "s long, d long, w double")
        vertices = {x for s, d, _ in arcs for x in (s, d)}
        got = {r.vertex: r.distance for r in G.shortest_paths(e, "s", "d", "w", 0).collect()}
        hops = {r.vertex: r.hops for r in G.bfs_levels(e, "s", "d", 0).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == least(arcs, 0, vertices)
    assert hops == least([(s, d, 1) for s, d, _ in arcs], 0, vertices)
    rounds = [p for name, p in made if name in ("graph_improved", "bfs_frontier")]
    assert len(rounds) > 4 and not any("hashpartitioning(_tk_s" in p for p in rounds)


def test_edges_of_a_hub_are_dealt_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(G, "FRONTIER_ROWS", 2, raising=False)
    monkeypatch.setattr(G, "BUCKET_EDGES", 50, raising=False)
    laid, real = [], getattr(G, "materialize_buckets", None)
    monkeypatch.setattr(G, "materialize_buckets", lambda df, *a: laid.append(real(df, *a)) or laid[-1], raising=False)
    rnd = random.Random(6)
    arcs = [(f"v{i}", "hub", 1) for i in range(8)] + [("hub", f"w{i}", 1 + i % 7) for i in range(900)]
    arcs += [("start", f"v{i}", 2 + i) for i in range(8)] + [(f"w{rnd.randrange(900)}", f"w{rnd.randrange(900)}", rnd.randint(0, 3)) for _ in range(600)]
    arcs += [("start", "hub", 9), (f"w{3}", "hub", 0)]
    e = spark.createDataFrame([(s, d, float(w)) for s, d, w in arcs] + [(None, "hub", 1.0), ("hub", None, 1.0), ("start", "w5", None)],
                              "s string, d string, w double")
    got = {r.vertex: r.distance for r in G.shortest_paths(e, "s", "d", "w", "start").collect()}
    assert got == least(arcs, "start", {x for s, d, _ in arcs for x in (s, d)})
    assert laid[0].where("_tk_s = 'hub'").select("_tk_k").distinct().count() == 18
    assert laid[0].count() == len(arcs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tablekit_")]


@pytest.mark.parametrize("chain", [0, 40])
def test_only_edges_of_low_vertices_are_moved_to_shorten_paths(spark, monkeypatch, chain):
    """A dense part, whose edges were all grouped by both ends twice over; without and with a chain behind it."""
    moved = []
    real = G.materialize

    def counted(df, name, **by):
        out = real(df, name, **by)
        if name == "graph_arcs":
            moved.append(out.count())
        return out

    monkeypatch.setattr(G, "materialize", counted)
    monkeypatch.setattr(G, "SHORTCUT_AFTER", 1)
    rnd = random.Random(7)
    arcs = [(i, rnd.randrange(60), rnd.randint(1, 50)) for i in range(60) for _ in range(25)]
    arcs += [(59 + i, 60 + i, 2) for i in range(chain)] + [(60 + i, 59 + i, 1) for i in range(0, chain, 3)] + [(70, 70, 1), (80, 80, 0)][:chain]
    e = spark.createDataFrame([(s, d, float(w)) for s, d, w in arcs], "s long, d long, w double")
    got = G.shortest_paths(e, "s", "d", "w", 0).collect()
    assert {r.vertex: r.distance for r in got} == least(arcs, 0, {x for s, d, _ in arcs for x in (s, d)})
    assert not any(r.negative_cycle for r in got)
    assert bool(moved) == bool(chain) and sum(moved) < 3 * chain + 1
