"""The Merkle dataset manifest against a plain walk of the contract."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tablekit.llm import manifest as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    """Levels of a list of digests, and (left, right) siblings of each leaf by level."""
    paths = [[] for _ in digests]
    at, level = list(range(len(digests))), digests
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 3 * 3: i // 3 * 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        level = [H(*level[j:j + 3]) for j in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], paths


def walk(rows):
    leaves = {}
    for doc, text, lang, source, n in rows:
        changed = text.replace("\n", "") if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 else text
        leaves.setdefault(source, []).append((doc is not None, doc or 0, H(*map(enc, (doc, source, lang, n, text))),
                                              H(*map(enc, (doc, source, lang, n, changed))), doc))
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([x[2] for x in sorted(leaves[s])]) for s in order}
    root, above = tree([subs[s][0] for s in order])
    out = []
    for s, more in zip(order, above):
        for (_, _, leaf, changed, doc), path in zip(sorted(leaves[s]), subs[s][1]):
            cur = changed
            for left, right in path + more:
                cur = H(left, cur, right)
            out.append((doc, leaf, subs[s][0], root, H(*[left + right for left, right in path + more]), cur, cur == root))
    return out


def result(frame):
    return M.verify_documents(frame).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def same(frame, rows):
    assert sorted(map(repr, map(tuple, result(frame).collect()))) == sorted(map(repr, walk(rows)))


def test_equals_a_plain_walk(spark):
    rnd = random.Random(2)
    rows = [(i, f"line {i}\nnext\n" * (i % 4), rnd.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{i % 13}", i) for i in range(400)]
    rows += [(7, "lone", "en", "Zürich", 4), (None, "a\nb", None, None, None), (None, None, "fr", None, 2), (8, None, None, "hot", None),
             (9, "", "en", "", 0), (-5, "x\n" * 3000, "en", "é", 5), (30, "other text, same id", "en", "hot", 1)]
    rows += [(12, "again\n", "en", "hot", 6)] * 30                                     # identical rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, Lo int, digest string, path string, grp int"
    frame = spark.createDataFrame([(*r, 1, "d", "p", 3) for r in rows], schema).repartition(6)
    same(frame, rows)


def test_every_small_count(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for n in (1, 3, 10):
        rows = [(i, "t\n", "en", "one", 2) for i in range(n)]
        same(spark.createDataFrame(rows, schema), rows)
    rows = [(i, "t\n", "en", f"s{i}", 2) for i in range(11)]        # lone leaves only
    same(spark.createDataFrame(rows, schema), rows)
    assert result(spark.createDataFrame([], schema)).count() == 0


def test_intervals_nest_and_partition_their_parent(spark):
    frame = spark.createDataFrame([(i, f"g{i % 2}" if i < 60 else "g0") for i in range(100)], "k long, g string")
    _, levels = M.manifest(frame.withColumn("digest", F.sha2(F.col("k").cast("string"), 256)), "g", ["k"])
    assert [nodes.count() for nodes in levels] == [100, 34, 12, 5, 2, 2, 1]   # 70 and 30 leaves, then 2 subroots
    for nodes in levels:
        for r in nodes.collect() if "kids" in nodes.columns else []:
            kids = r["kids"]
            assert r["lo"] == kids[0]["lo"] and r["hi"] == kids[-1]["hi"] and len(kids) <= 3
            assert all(a["hi"] == b["lo"] for a, b in zip(kids, kids[1:]))
            assert r["digest"] == H(*[k["digest"] for k in kids])
