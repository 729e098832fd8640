"""SimHash near-dedup against brute force over all pairs."""

import random

import xxhash

from llm_corpus import prose  # noqa: F401

from tablekit.llm import simhash_dedup as S

SCHEMA = "doc_id long, text string"


def fingerprint(text):
    ws, cur = [], b""
    for b in (text or "").encode():
        if b == 0x20 or 9 <= b <= 13:
            if cur:
                ws.append(cur)
            cur = b""
        else:
            cur += bytes([b + 32 if 65 <= b <= 90 else b])
    if cur:
        ws.append(cur)
    grams = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [b" ".join(ws)] * bool(ws)
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, bits=3):
    fp = sorted({fingerprint(t) for _, t in rows})
    root = {f: f for f in fp}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fp):
        for b in fp[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for d, t in rows:
        if d is not None:
            f = find(fingerprint(t))
            low[f] = min(low.get(f, d), d)
    return sorted(((d, fingerprint(t), low.get(find(fingerprint(t)))) for d, t in rows), key=repr)


def corpus(prose, seed):
    rnd = random.Random(seed)
    rows = []
    for d in range(150):
        t = prose(seed * 1000 + d, rnd.choice([0, 1, 2, 3, 40, 300]))
        if d % 3 == 1 and rows:
            ws = (rows[rnd.randrange(len(rows))][1] or "").split(" ")
            for _ in range(rnd.randint(0, 3)):
                ws[rnd.randrange(len(ws))] = "Changed"
            t = "\t".join(ws[:2]) + " \n" + " ".join(ws[2:])
        rows.append((1000 - d, t))
    return rows + [(7, None), (7, ""), (None, "ÀB c"), (None, "Àb C"), (3, rows[5][1]), (3, rows[5][1])]


def test_equals_brute_force(spark, prose):
    for seed, max_group in ((1, 1_000_000), (2, 1)):
        rows = corpus(prose, seed)
        got = S.fingerprint_components(spark.createDataFrame(rows, SCHEMA), max_group=max_group).collect()
        got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=repr)
        assert got == brute(rows)


def test_chains_and_split_groups(spark):
    """Fingerprints in chains of near neighbours, with every group split."""
    rnd = random.Random(3)
    fps = set()
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for _ in range(rnd.randint(1, 4)):
                f ^= 1 << rnd.randrange(64)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3 and find(a) != find(b):
                root[find(a)] = find(b)
    frame = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    for max_group in (1_000_000, 2):
        links = S.components(S.trie_links(frame, 3, max_group))
        of = {r["node"] % 2**64: r["root"] % 2**64 for r in links.collect()}
        want, got = {}, {}
        for f in fps:
            want.setdefault(find(f), set()).add(f)
            got.setdefault(of.get(f, f), set()).add(f)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_keep_first_keeps_one_row_of_each_group(spark, prose):
    rows = corpus(prose, 4)
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", __key string")
    kept = [(r["doc_id"], r["text"]) for r in S.keep_first(frame).collect()]
    groups = {}
    for d, f, c in brute(rows):
        groups.setdefault(c if c is not None else ("fp", f), []).append(d)
    assert len(kept) == len(groups)
    for c, members in groups.items():
        if not isinstance(c, tuple):
            assert sum(d == c for d, _ in kept) >= 1 and c in members


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.fingerprint_components(empty).count() == 0
    assert S.keep_first(empty).count() == 0


def near_copy(text):
    """``text`` with one word changed, and a fingerprint 1 to 3 bits away."""
    ws = text.split(" ")
    for k in range(len(ws)):
        other = " ".join(ws[:k] + ["changed"] + ws[k + 1:])
        if 1 <= (fingerprint(text) ^ fingerprint(other)).bit_count() <= 3:
            return other
    raise AssertionError("no near copy")


def test_keep_first_tells_components_apart(spark, prose):
    """Unrelated texts under one id all stay; near copies without ids are one group."""
    a, b, c, d = (prose(900 + k, 300) for k in range(4))
    rows = [(1, a), (1, b), (2, near_copy(a)), (3, near_copy(b)), (1, a), (None, c), (None, near_copy(c)), (None, c), (None, d)]
    kept = [(r["doc_id"], r["text"]) for r in S.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(kept) == 4
    assert {(1, a), (1, b), (None, d)} <= set(kept) and ((None, c) in kept) != ((None, near_copy(c)) in kept)
