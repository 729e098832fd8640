import __spark_entry__ as E
from conftest import SF_SMALL

from tablekit.plans.bindings import BINDINGS


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["month", "o_custkey", "total_spent", "rank"]


def test_every_query_without_oracle_runs_on_smallest_fixture(spark):
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    for name in set(BINDINGS) - set(oracle):
        df = qs[name](spark, SF_SMALL)
        assert df.count() >= 0, name


def test_nothing_else_imports_the_training_data_operators():
    import pathlib
    import re

    root = pathlib.Path(E.__file__).parent
    for f in root.glob("tablekit/**/*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", f.read_text(), re.M), f


def test_every_query_matches_its_oracle_on_smallest_fixture(spark):
    import os
    import sys

    import duckdb
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check_oracle import TABLES, canon

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = []
    for name, text in ((n, q) for n, q in oracle.items() if n in BINDINGS):
        df = qs[name](spark, SF_SMALL)
        srows, scols = [tuple(r) for r in df.collect()], df.columns
        rel = con.execute(text)
        ocols, orows = [d[0] for d in rel.description], rel.fetchall()
        if sorted(scols) != sorted(ocols) or canon(srows, scols) != canon(orows, ocols):
            bad.append(name)
    assert bad == []
