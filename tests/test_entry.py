"""The driver contract: entry / queries / oracle_sql, checked against DuckDB at sf0.001."""

import os
import sys

import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 * 20 and set(df.columns) == {"project", *E.RULE_OUT}
    assert {r.project for r in rows} == {"click", "error", "purchase", "signup", "view", None}


#: The training-data queries are tested with their operators, in tests/llm.
OWN = sorted(n for n in E.queries() if n != "pipeline" and not n.startswith("op"))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql())


def test_oracle_is_independent():
    """A changed default of the package must not change the oracle: it uses no name of the package."""
    text = open(E.__file__, encoding="utf-8").read().split("# DuckDB oracle")[1]
    for name in ("default_suite", "country_codes", "BATCH_COLUMNS", "R.", "P.", "BOUNDS[", "assay"):
        assert name not in text.replace("RUN_BOUNDS", "").replace("DAY_BOUNDS", ""), name


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, name):
    import duckdb
    from check_oracle import _rows
    from assay.sources.tables import TABLES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = E.queries()[name](spark, sf)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, rel.fetchall())
