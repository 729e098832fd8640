"""Decontamination against brute force over every item-sized window."""

import random
import re
from collections import Counter

from llm_corpus import prose  # noqa: F401

from tablekit.llm import decontaminate as D


def words(t):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower()) if w]


def grams(ws, k):
    return [tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)]


def brute(docs, items, limit=0.8):
    out = {}
    for d, t in docs:
        ws = words(t)
        for i, u in items:
            us = words(u)
            if not us or not ws:
                continue
            k = min(5, len(us))
            a, b = grams(ws, k), grams(us, k)
            if not set(a) & set(b):
                continue  # every window has similarity 0
            want = Counter(b)
            size = min(len(a), len(b))
            for s in range(len(a) - size + 1 if size else 0):
                got = Counter(a[s:s + size])
                both = sum((got & want).values())
                sim = both / (size + len(b) - both)
                if sim >= limit and sim > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (sim, s)
    return {k: (round(v[0], 9), v[1]) for k, v in out.items()}


def corpus(prose):
    rnd = random.Random(9)
    items = [(i, prose(50 + i, rnd.randint(15, 57)) + ".") for i in range(12)] + [(90, "ab cd"), (91, ""), (92, None), (93, prose(50, 20))]
    items.append((94, items[0][1]))
    docs = []
    for d in range(80):
        t = prose(7000 + d, rnd.randint(0, 200)).split(" ")
        if d % 2:
            ws = items[rnd.randrange(12)][1].split(" ")
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(ws))
                ws[at:at + rnd.randint(0, 1)] = [rnd.choice(["Zebra", "", "x, y"])]
            at = rnd.randint(0, len(t))
            t = t[:at] + [", ".join(ws) if d % 4 == 1 else " ".join(ws).upper()] + t[at:]
        docs.append((d, " ".join(t)))
    return docs + [(200, None), (201, ""), (202, "Ab, CD"), (203, items[3][1][:-8]), (None, items[4][1])], items


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, gram int")
    i = spark.createDataFrame(items, "item_id long, text string")
    return d, i, D.contaminated(d, i, **options)


def test_equals_brute_force(spark, prose):
    docs, items = corpus(prose)
    want = brute(docs, items)
    assert len(want) > 15
    for options in ({}, {"max_broadcast": 0}):
        got = run(spark, docs, items, **options)[2].collect()
        assert {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start"]) for r in got} == want
        assert len(got) == len(want)


def test_drops_only_contaminated_documents(spark, prose):
    docs, items = corpus(prose)
    d, i, _ = run(spark, docs, items)
    bad = {k for k, _ in brute(docs, items)}
    left = D.drop_contaminated(d, i)
    assert left.columns == d.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((k for k, _ in docs if k not in bad), key=repr)


def test_radius_loses_nothing_at_the_similarity():
    """Hamming distances of windows at similarity 0.8 stay within the radius."""
    rnd = random.Random(2)
    worst = 0
    for _ in range(4000):
        m = rnd.randint(11, 53)
        keep = -(-2 * 8 * m // 18)
        a = [rnd.getrandbits(64) for _ in range(m)]
        b = a[:keep] + [rnd.getrandbits(64) for _ in range(m - keep)]
        f, g = ([2 * sum(h >> x & 1 for h in hs) > m for x in range(64)] for hs in (a, b))
        worst = max(worst, sum(x != y for x, y in zip(f, g)))
    assert worst <= D.RADIUS


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    i = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert D.contaminated(d, i).count() == 0
    assert D.drop_contaminated(full, i).count() == 1
    assert D.drop_contaminated(d, full.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_truncated_items_and_repeated_ids(spark, prose):
    """Documents that are an item without some words at either end, and items that share an id."""
    items = [(i, prose(300 + i, n)) for i, n in enumerate((9, 15, 20, 29, 40, 57))]
    items += [items[3], (2, items[4][1]), (2, prose(320, 20)), (1, items[1][1] + " zebra")]
    short = [(20 + i, prose(500 + i, 9)) for i in range(16)]
    items += short
    docs = []
    for _, u in items[:6] + items[8:9] + short:
        ws = u.split(" ")
        cuts = len(ws) // 4 + 1
        docs += [" ".join(ws[a:len(ws) - b]) for a in range(cuts) for b in range(cuts - a)]
    docs += [prose(400, 30) + " " + t + " " + prose(401, 30) for t in (items[2][1], items[8][1], items[2][1] + " " + items[4][1])]
    docs = list(enumerate(docs))
    want = brute(docs, items)
    for options in ({}, {"max_broadcast": 0}):
        got = run(spark, docs, items, **options)[2].collect()
        assert {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start"]) for r in got} == want
        assert len(got) == len(want)


def test_items_without_an_id_are_found(spark, prose):
    text = prose(77, 30)
    docs = spark.createDataFrame([(1, prose(1, 40) + " " + text + " " + prose(2, 40)), (2, prose(3, 90)), (3, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, text), (None, prose(78, 30)), (4, prose(79, 12))], "item_id long, text string")
    found = [(r["doc_id"], r["item_id"], r["similarity"]) for r in D.contaminated(docs, bench).orderBy("doc_id").collect()]
    assert found == [(1, None, 1.0), (3, None, 1.0)]
    assert [r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()] == [2]
