"""Merkle fingerprints: equality, edits, and neighbours against a plain walk."""

import hashlib

from llm_corpus import prose  # noqa: F401

from tablekit.llm import merkle as M


def test_roots_test_equality_and_branches_locate_edits(prose):
    lines = [prose(i, 9) + "." for i in range(60)]
    text = "\n".join(lines)
    tree = M.fingerprint(text)
    assert M.fingerprint(str(text)) == tree and M.locate_edits(tree, tree) == []
    for k in (0, 17, 59):
        other = "\n".join(lines[:k] + ["changed " + lines[k]] + lines[k + 1:])
        edit = M.fingerprint(other)
        assert edit.partition("|")[0] != tree.partition("|")[0]
        found = M.locate_edits(tree, edit)
        flat, n = {}, 0
        for s, section in enumerate(tree.partition("|")[2].split("/")):
            for p, _ in enumerate(section[9:].split(".")):
                flat[s, p] = n
                n += 1
        assert [flat[x] for x in found] == [k]
        assert 0.9 < M.likeness(tree, edit) < 1


def test_every_text_has_a_tree():
    texts = ["", " ", "\n", "\n\n", "a", "a\n", " a", "ab cd", "é" * 9, "one two three four five six seven eight nine ten\n\nx",
             "w" * 100_000, "same " * 3000, "x\r\ny\tz"]
    trees = [M.fingerprint(t) for t in texts]
    assert len(set(trees)) == len(texts) and M.fingerprint(None) == trees[0]
    for a in trees:
        for b in trees:
            assert 0 <= M.likeness(a, b) <= 1 and (M.likeness(a, b) == 1) == (a == b)
    for t, tree in zip(texts, trees):
        if t:  # leaves cover the text without loss
            import numpy as np
            starts, paragraphs = M._leaf_starts(np.frombuffer(t.encode(), dtype=np.uint8))
            assert starts[0] == 0 and (np.diff(starts) > 0).all() and len(starts) == len(M._leaves(tree))
            assert len(paragraphs) == len(t.rstrip("\n").split("\n")) + (len(t) - len(t.rstrip("\n")) - 1 if t.endswith("\n") else 0) or t.strip("\n") == ""


def test_neighbours_equal_a_plain_walk(spark, prose):
    rows = [(i * 7 % 101, prose(i, i % 40)) for i in range(101)] + [(None, f"last of all {i}") for i in range(40)] + [(200, None), (201, ""), (50, "same id")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bucket int").repartition(6)
    got = {}
    for r in M.compare_neighbours(frame, bucket_bytes=500).collect():
        got.setdefault((r["doc_id"], r["fingerprint"]), r)
    assert len(got) == len(rows)
    key = {(r["doc_id"], r["text"]): r["k"] for r in frame.selectExpr("*", "xxhash64(text) as k").collect()}
    walk = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, key[r]))
    for (d, t), (_, u) in zip(walk, walk[1:] + walk[:1]):
        t, u = t or "", u or ""
        k = len(t) // 4
        edited = t[:len(t) - k] + u[:k]
        r = got[d, M.fingerprint(t)]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["edited_fingerprint"] == M.fingerprint(edited)
        assert r["near_edited"] == M.likeness(M.fingerprint(t), M.fingerprint(edited))
        assert r["near_next"] == M.likeness(M.fingerprint(t), M.fingerprint(u))


def test_one_row_and_no_row(spark):
    one = M.compare_neighbours(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert M.compare_neighbours(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_different_texts_differ_in_root_and_leaves():
    """Words whose sums agree in all powers of two (Thue-Morse and its complement)."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    for before in ("", "some words in front of it ", "one\ntwo\n"):
        x, y = M.fingerprint(before + word), M.fingerprint(before + other)
        assert x.partition("|")[0] != y.partition("|")[0] and M.likeness(x, y) < 1
    texts = {f"{i} paragraph\n{j}" for i in range(60) for j in range(60)}
    assert len({M.fingerprint(t).partition("|")[0] for t in texts}) == len(texts)
