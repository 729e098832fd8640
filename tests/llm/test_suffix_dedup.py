"""Suffix-array dedup against brute force over every 100-byte string."""

import hashlib
import os
import random

import pytest

from llm_corpus import prose  # noqa: F401

from tablekit.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string"


def brute(rows, width):
    seen, out = {}, {}
    for d, t in sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            w = raw[p:p + width]
            if w in seen:
                gone[p:p + width] = b"\1" * width
            seen.setdefault(w, (d, p))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d, t] = (sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *out[d, t]) for d, t in rows), key=repr)


def run(spark, rows, width=100, **options):
    got = S.remove_repeats(spark.createDataFrame(rows, SCHEMA), width=width, **options).collect()
    return sorted(((r["doc_id"], sum(b - a for a, b in zip(r["starts"], r["ends"])), len(r["starts"]),
                    hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=repr)


def corpus(prose, seed):
    rnd = random.Random(seed)
    common = prose(1000 + seed, 22)
    line = prose(2000 + seed, 12)
    rows = []
    for d in range(60):
        t = prose(seed * 100 + d, rnd.randint(1, 120))
        kind = d % 6
        if kind == 1:
            t = t[:len(t) // 2] + " " + common + " é " + t[len(t) // 2:]
        if kind == 2:
            t = line + "\n" + t + "\n" + common + line + common
        if kind == 3 and rows:
            t = rows[rnd.randrange(len(rows))][1]
        if kind == 4 and rows:
            o = rows[rnd.randrange(len(rows))][1] or ""
            t = o[: len(o) // 2] + "#" + o[len(o) // 2:]
        rows.append((d * 3, t))
    return rows + [(500, None), (501, ""), (502, "x" * 99), (503, "y" * 400), (None, rows[8][1]), (9, rows[3][1])]


@pytest.mark.parametrize("seed,max_group", [(1, 100_000), (2, 1)])
def test_equals_brute_force(spark, prose, seed, max_group):
    rows = corpus(prose, seed)
    assert run(spark, rows, max_group=max_group) == brute(rows, 100)


def test_segments_of_long_texts(spark, prose, monkeypatch):
    rows = [(1, prose(3, 4000)), (2, prose(4, 50) + prose(3, 4000)[5000:9000])]
    for k in range(2):
        monkeypatch.setattr(S, "_SEGMENT", (1 << 20, 700)[k])
        blocks = [b"".join([rows[0][1].encode()]), rows[1][1].encode()]
        assert sum(S.contexts(blocks, 100, S.GRAM)[2] - 99) == sum(len(b) - 99 for b in blocks)
    assert run(spark, rows) == brute(rows, 100)


def test_deep_shallow_sort_is_a_suffix_sort():
    rnd = random.Random(1)
    for _ in range(200):
        strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.choice([0, 3, 10, 40]))) for _ in range(rnd.randint(1, 12))]
        order, common = S.deep_shallow_sort(strings, rnd.choice([0, 4, 24]), rnd.choice([1, 8]))
        got = [strings[i] for i in order]
        assert got == sorted(strings)
        assert common == [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(got, got[1:])]


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.remove_repeats(empty).count() == 0
    extra = spark.createDataFrame([(1, "a" * 250, 5, "z")], "doc_id long, text string, __order int, starts string")
    out = S.remove_repeats(extra, names=("k", "s", "e")).first()
    assert (out["__order"], out["starts"], out["s"], out["e"]) == (5, "z", [1], [250])
