"""The pipeline, stage by stage, against brute force; and the SQL oracles."""

import os
import sys

import duckdb
import pytest
from conftest import SF_SMALL
from test_decontaminate import brute as leaks
from test_line_dedup import brute as lines
from test_packing import check
from test_simhash_dedup import brute as near

import corpus_pipeline
from tablekit.llm.oracle import ORACLE
from tablekit.llm.queries import QUERIES, op2_quality_classifier

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in op2_quality_classifier(spark, SF_SMALL).collect() if r["predicted"]}
    for (name, stage), expect in zip(corpus_pipeline.STAGES[:-1], (
            lambda: {d: v for d, v in want.items() if d in good},
            lambda: {d: (t, s) for d, t, s, _ in lines([(d, t, s, "") for d, (t, s) in want.items()], 0.1, 5)},
            lambda: {d: want[d] for d, _, c in near([(d, t) for d, (t, _) in want.items()]) if d == c},
            lambda: {d: v for d, v in want.items() if d not in {k for k, _ in leaks([(d, t) for d, (t, _) in want.items()], bench)}})):
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), "t-stage")
        assert docs.columns == COLUMNS, name
        want = expect()
        rows = docs.collect()
        assert {r["doc_id"]: (r["text"], r["source"]) for r in rows} == want and len(rows) == len(want), name
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    rows = [(r["doc_id"], r["piece"], r["start"], r["length"], None, r["ids_crc32"], r["sequence_id"], r["offset"]) for r in out]
    check(rows, [(d, t) for d, (t, _) in want.items()], 2048)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    from check_oracle import canon

    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert canon([tuple(r) for r in got.collect()], got.columns) == canon(want.fetchall(), columns)
