"""License scans: exact set-similarity join of text blocks with license
templates (DataFrame functions only).

A block is a line; with ``wrapped`` also any run of as many consecutive words
of the text as the template has, whatever line breaks lie in it, so a wrapped
notice counts like one on a single line.  Blocks and templates are sets of
words.  A block meets
a template when it holds at least ``threshold`` of the template's words.
Words of no template can never count, so each line is reduced to its template
words first (lossless); both sides order them by how often the whole corpus
has them, rarest first, and three filters run before verification:

* length: a block with fewer than ceil(threshold * |T|) template words fails;
* prefix: it must hold one of the |T| - need + 1 rarest words of T, which is
  the join key;
* positional: the words from the first shared one on must still suffice.

Runs of words are made only around a word of the prefix, and only where the
words within reach of it suffice; a run within a line adds nothing to it.

Independently, phrases (consecutive words) give the base labels with places.

The template vocabulary is fixed and small, so its corpus counts (one row a
word) and the template index are bounded by the templates, not the corpus.
Hits are summed per document text map-side.

Defined results: null text is empty: no words, no labels, score 0; rows with
equal doc_id and text get equal results, equal ids with other texts do not
mix; a null doc_id stays; extra columns are ignored; an empty table works.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import ascii_lower, col, computed

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
RAW_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # before lower-casing

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Template notices of public licenses and their labels.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "gnu lesser general public license version 3": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl",
    "all rights reserved": "reserved",
}

THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Words of any case; ASCII apart from letters and digits separates."""
    return F.filter(F.split(text, RAW_SEPARATORS, -1), lambda w: w != "")


def _ascii(word: Column) -> Column:
    """Words whose lower case may stand for A-Z only."""
    return F.octet_length(word) == F.length(word)


def _is(word: Column, lower: str) -> Column:
    return (F.lower(word) == lower) & _ascii(word)


def _positions(ws: Column, word: str) -> Column:
    return F.filter(F.transform(ws, lambda w, i: F.when(_is(w, word), i)), lambda i: i.isNotNull())


def _stands(ws: Column, parts: list[str]) -> Callable[[Column], Column]:
    """Whether the words from a place on are ``parts``."""
    def test(i: Column) -> Column:
        return F.coalesce(reduce(and_, [_is(F.get(ws, i + k), w) for k, w in enumerate(parts)]), F.lit(False))
    return test


def _place(label: str) -> Callable[[Column], Column]:
    return lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label"))


def phrase_places(text: Column, ws: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """array<struct<at, label>> of every place where a phrase's words stand
    consecutively in ``ws``, the words of ``text``: a column that is there already,
    as every test of a place looks into it."""
    found = []
    for phrase, label in phrases.items():
        parts = phrase.split(" ")
        held = F.filter(_positions(ws, parts[0]), _stands(ws, parts))
        # the phrase's words in any case, anywhere: a cheap test that loses none
        maybe = F.lit(True)
        for w in parts:
            maybe = maybe & text.rlike("(?i)" + w)
        found.append(F.when(maybe, F.transform(held, _place(label))))
    empty = F.array().cast("array<struct<at:bigint,label:string>>")
    return F.concat(*[F.coalesce(x, empty) for x in found])


def template_hits(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                  doc_id: str = "doc_id", text: str = "text", wrapped: bool = False) -> DataFrame:
    """(doc_id, text_hash, line, label, containment): every block that meets a
    template; runs of words have no line."""
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.split(" ")})
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).where(F.col("text").isNotNull())
    tokens = rows.select(F.explode(F.split("text", RAW_SEPARATORS, -1)).alias("w"))
    counts = (tokens.where(F.lower("w").isin(vocabulary) & _ascii(F.col("w")))
              .groupBy(F.lower("w").alias("w")).agg(F.count(F.lit(1)).alias("n")).collect())
    often = {r["w"]: r["n"] for r in counts}  # at most one row per template word
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    sets = [(label, sorted(set(t.split(" ")), key=order.index), len(t.split(" "))) for t, label in templates.items()]
    need = [math.ceil(threshold * len(s) - 1e-9) for _, s, _ in sets]
    index = spark.createDataFrame(
        [(k, label, w, at, len(s), need[k], s, run) for k, (label, s, run) in enumerate(sets)
         for at, w in enumerate(s[:len(s) - need[k] + 1])],
        "template int, label string, word string, at int, size int, need int, words array<string>, run int")
    in_order = F.array(*[F.lit(w) for w in order])
    lines = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("line", "block"))
    # blocks as their template words, rarest first
    sets_of = F.array_intersect(in_order, F.transform(F.split("block", RAW_SEPARATORS, -1), ascii_lower))
    blocks = (lines.where(F.length("block") > 0)
              .select("doc_id", "text_hash", "line", sets_of.alias("held"))
              .where(F.size("held") >= min(need)))
    probes = blocks.select("*", F.posexplode("held").alias("pos", "word"))
    candidates = (probes.join(F.broadcast(index), "word")
                  .where(F.size("held") >= F.col("need"))                                        # length
                  .where(F.least(F.col("size") - F.col("at"), F.size("held") - F.col("pos"))     # positional:
                         + F.least(F.col("at"), F.col("pos")) >= F.col("need")))                 # shared words left
    shared = F.size(F.array_intersect("held", "words"))
    met = (candidates.where(shared >= F.col("need"))
           .select("doc_id", "text_hash", "line", "label", (shared / F.col("size")).alias("containment")))
    if not wrapped:
        return met
    prefixes = sorted({w for k, (_, s, _) in enumerate(sets) for w in s[:len(s) - need[k] + 1]})
    return met.unionByName(_runs_met(rows, index, prefixes, max(run for _, _, run in sets)))


def _runs_met(rows: DataFrame, index: DataFrame, prefixes: list[str], reach: int) -> DataFrame:
    """Hits of runs of words, from the words within ``reach`` of each prefix word."""
    several = rows.where(F.col("text").contains("\n")).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    body = computed(several, "ws", words(F.col("text"))).drop("text")

    def around(w: Column, i: Column) -> Column:
        first = F.greatest(i - (reach - 1), F.lit(0))
        near = F.transform(F.slice("ws", first + 1, i - first + reach), ascii_lower)
        return F.when(F.lower(w).isin(prefixes) & _ascii(w),
                      F.struct(F.lower(w).alias("word"), (i - first).alias("pos"), near.alias("near")))

    places = F.filter(F.transform("ws", around), lambda x: x.isNotNull())
    probes = body.select("doc_id", "text_hash", F.explode(places).alias("p")).select("doc_id", "text_hash", "p.*")
    candidates = (probes.join(F.broadcast(index), "word")
                  .where(F.size(F.array_intersect("near", "words")) >= F.col("need")))
    starts = F.sequence(F.greatest(F.col("pos") - F.col("run") + 1, F.lit(0)), F.col("pos"))
    best = F.array_max(F.transform(starts, lambda s: F.size(F.array_intersect(F.slice("near", s + 1, F.col("run")), "words"))))
    return (computed(candidates, "shared", best).where(F.col("shared") >= F.col("need"))
            .select("doc_id", "text_hash", F.lit(None).cast("int").alias("line"), "label",
                    (F.col("shared") / F.col("size")).alias("containment")))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
                  threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", wrapped: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, places (of phrases), hits (labels of
    templates), containment (the highest)."""
    hits = (template_hits(docs, templates, threshold, doc_id, text, wrapped)
            .groupBy("doc_id", "text_hash")
            .agg(F.collect_set("label").alias("hits"), F.max("containment").alias("containment")))
    body = F.coalesce(col(text), F.lit(""))
    split = computed(docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), body.alias("text")),
                     "ws", words(F.col("text")))
    base = split.select("doc_id", "text_hash", F.size("ws").cast("long").alias("n_words"),
                        phrase_places(F.col("text"), F.col("ws"), phrases).alias("places"))
    other = hits.select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"), "hits", "containment")
    return (base.join(other, base["doc_id"].eqNullSafe(F.col("h_id")) & (base["text_hash"] == F.col("h_hash")), "left")
            .select("doc_id", "n_words", "places",
                    F.coalesce("hits", F.array().cast("array<string>")).alias("hits"),
                    F.coalesce("containment", F.lit(0.0)).alias("containment")))
