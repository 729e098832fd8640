"""Quality classifier: held-out accuracy, and rules against a plain evaluation."""

import math
import zlib

import pytest
from conftest import SF_SMALL
from llm_corpus import prose  # noqa: F401

from tablekit.llm import quality as Q
from tablekit.llm.queries import op2_quality_classifier

SF = SF_SMALL.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in op2_quality_classifier(spark, SF).collect()}


def test_held_out_accuracy(spark, scored):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(scored[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in scored)
    assert sum(scored[d]["predicted"] == labels[d] for d in held) / len(held) >= 0.97
    good = [scored[d]["score"] for d in held if labels[d]]
    bad = [scored[d]["score"] for d in held if not labels[d]]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc >= 0.98
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored.values())


def test_compiled_rules_equal_a_plain_evaluation(spark):
    texts = ["", None, "a b c", "LOUD!! TEXT!!", "x | y | z", "same same same", "É\nlong " + "w" * 50_000]
    model = Q.RuleModel(0.25, [((("upper", ">", 0.3), ("bangs", ">", 0.01)), -3.0), ((("distinct_words", "<=", 0.5),), -1.5),
                               ((("bars", "<=", 0.0),), 2.0)])
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "id int, text string")
    got = {r["id"]: r["p"] for r in frame.withColumn("st", Q.statistics_of(frame["text"])).withColumn("p", model.score("st")).collect()}
    for i, t in rows:
        st = dict(zip(Q.STATISTICS, Q.statistics(t)))
        z = model.bias + sum(w for rule, w in model.rules if all(st[s] <= v if op == "<=" else st[s] > v for s, op, v in rule))
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-12)


def test_labels_without_both_kinds_reject_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (2, ""), (2, "")], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, None), (2, 0), (2, 1), (None, 0)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        assert Q.keep_good(docs, frame).count() == 4
    assert Q.keep_good(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_inputs_of_the_score_are_the_text_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = docs.select("doc_id", "text").unionByName(docs.selectExpr("doc_id + 1000000 as doc_id", "text"))
    rows = Q.score_quality(both.selectExpr("*", "1 as __stats", "'z' as label"), labels).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert all(score[d] == score[d + 1000000] for d in score if d < 1000000)


def test_labels_of_one_kind_give_their_rate(spark, prose):
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(30)], "doc_id long, text string")
    for kind in (0, 1):
        labels = spark.createDataFrame([(i, kind) for i in range(30)], "doc_id long, quality int")
        assert {round(r["score"], 6) for r in Q.score_quality(docs, labels).collect()} == {float(kind)}
