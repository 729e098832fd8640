"""Quality classifier: a sparse rule ensemble.

Statistics of whole texts (shares of letter cases, symbols and bars, word
and line repetition, word lengths, ...) feed a small forest; every path from
a root to a node below it becomes a conjunctive rule over the statistics; a
lasso logistic regression weighs the rules, most of them with zero; the rest
is compiled into one Spark column expression.

The forest and the weights are fitted by Spark ML on at most ``max_train``
labelled rows, taken in order of a hash of the id, so the bound is the same
at every corpus size.  Scoring reads every whole text once.

Defined results: null text is empty; empty texts get a score like any other;
labels that are null, or contradict each other on one id, are not learned
from; without labels of both kinds every score is 1 (nothing is known against
any text); repeated rows get equal scores; a null id scores like any other;
extra columns stay; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import col, fresh
from tablekit.session import materialize

MAX_TRAIN = 6_000
TREES, DEPTH, LASSO = 16, 3, 0.002
STATISTICS = (
    "log_bytes", "log_words", "upper", "digits", "symbols", "bars", "bangs", "stops", "commas", "blanks", "other_bytes",
    "word_bytes", "longest_word", "distinct_words", "repeated_next", "line_bytes", "repeated_lines", "short_words",
    "capital_words", "marked_words")

_KIND = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "letters": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789", "symbols": b"#$%&*+<=>@[\\]^_`{}~", "bars": b"|", "bangs": b"!", "stops": b".",
    "commas": b",;:", "blanks": b" \t\n\r\x0b\x0c"}
_MASK = np.array([[b in set(chars) for b in range(256)] for chars in _KIND.values()], dtype=np.int64)


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kind = dict(zip(_KIND, (_MASK @ seen).tolist()))
    words = raw.split()
    w = max(1, len(words))
    lengths = list(map(len, words))
    lines = raw.split(b"\n")
    distinct = len(set(words))
    return (
        float(np.log1p(len(raw))), float(np.log1p(len(words))), kind["upper"] / max(1, kind["letters"]), kind["digits"] / n,
        kind["symbols"] / n, kind["bars"] / n, kind["bangs"] / n, kind["stops"] / n, kind["commas"] / n, kind["blanks"] / n,
        float(seen[128:].sum()) / n, sum(lengths) / w, float(max(lengths, default=0)), distinct / w,
        sum(map(bytes.__eq__, words, words[1:])) / w, len(raw) / len(lines), 1 - len(set(lines)) / len(lines),
        sum(x <= 2 for x in lengths) / w, sum(map(bytes.istitle, words)) / w,
        sum(map(bytes.isalnum, words)) / w)


def statistics_of(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype="float64")

    return measure(text)


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


Rule = tuple[tuple[str, str, float], ...]


def _paths(node, above: dict) -> list[Rule]:
    """The conjunctive rules of a fitted tree: one for each node below the root."""
    out = []
    if above:
        out.append(tuple(sorted((s, op, t) for (s, op), t in above.items())))
    if node.subtreeDepth() > 0:
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], split.threshold()
        low, high = dict(above), dict(above)
        low[name, "<="] = min(at, above.get((name, "<="), at))
        high[name, ">"] = max(at, above.get((name, ">"), at))
        out += _paths(node.leftChild(), low) + _paths(node.rightChild(), high)
    return out


def rule_column(rule: Rule, stats: str) -> Column:
    test = F.lit(True)
    for name, op, at in rule:
        value = F.col(f"{stats}.{name}")
        test = test & (value <= at if op == "<=" else value > at)
    return F.when(test, 1.0).otherwise(0.0)


class RuleModel:
    """Weighted rules; ``score`` compiles them into a column expression."""

    def __init__(self, bias: float, rules: list[tuple[Rule, float]]):
        self.bias, self.rules = bias, rules

    def score(self, stats: str) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + rule_column(rule, stats) * weight
        return 1.0 / (1.0 + F.exp(-total))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                  label_id: str = "doc_id", max_train: int = MAX_TRAIN) -> DataFrame:
    """(label, stats, turn, id) of at most ``max_train`` labelled documents that are not held out."""
    usable = (labels.select(col(label_id).alias("id"), col(label).alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
              .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
              .select("id", "label", F.xxhash64("id").alias("turn")))
    # the sample has at most max_train narrow rows, so it can be broadcast
    sample = usable.orderBy("turn", "id").limit(max_train)
    held = docs.select(col(doc_id).alias("doc"), col(text).alias("text")).join(F.broadcast(sample), F.col("doc") == F.col("id"))
    return held.select(F.col("label").cast("double").alias("label"), statistics_of(F.col("text")).alias("stats"), "turn", "id")


def fit_rules(train: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleModel:
    """Forest paths as rules, weighted by lasso logistic regression."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    kinds = train.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).first()
    if not kinds["n0"] or not kinds["n1"]:  # one kind of label, or none: nothing tells texts apart
        return RuleModel(-50.0 if kinds["n0"] else 50.0, [])
    values = array_to_vector(F.array(*[F.col(f"stats.{s}") for s in STATISTICS]))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=17, featureSubsetStrategy="onethird", maxBins=64,
                                    minInstancesPerNode=3, labelCol="label", featuresCol="features")
    model = forest.fit(train.select("label", values.alias("features")))
    found: set[Rule] = set()
    for tree in model._java_obj.trees():
        found.update(_paths(tree.rootNode(), {}))
    rules = sorted(found)
    if not rules:
        return RuleModel(float(np.log(kinds["n1"] / kinds["n0"])), [])
    fired = array_to_vector(F.array(*[rule_column(r, "stats") for r in rules]))
    lasso_fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=80, labelCol="label", featuresCol="fired")
    weights = lasso_fit.fit(train.select("label", fired.alias("fired")))
    return RuleModel(float(weights.intercept), [(r, float(w)) for r, w in zip(rules, weights.coefficients) if w])


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                  score: str = "score", max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` plus ``score`` in 0..1; higher: label 1 is likelier."""
    # written by the scan's own tasks; the sample, at most max_train narrow rows, then makes one partition in a fixed order
    train = materialize(training_rows(docs, labels, doc_id, text, label, max_train=max_train), "quality-train")
    model = fit_rules(train.coalesce(1).sortWithinPartitions("turn", "id"))
    stats, = fresh(docs, "stats")
    if not model.rules:
        return docs.withColumn(score, model.score(stats))
    return docs.withColumn(stats, statistics_of(col(text))).withColumn(score, model.score(stats)).drop(stats)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    score, = fresh(docs, "score")
    return score_quality(docs, labels, score=score, **options).where(F.col(score) >= threshold).drop(score)
