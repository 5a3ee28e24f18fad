"""The registered queries, whole rows with names and types of values, against their DuckDB SQL."""

import os
import sys

import pytest

from assay.llm.registry import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb
    from check_oracle import _rows
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(columns)
    want = rel.fetchall()
    assert _rows(df.columns, rows) == _rows(columns, want) and rows
    for at, c in enumerate(columns):
        mine, theirs = df.columns.index(c), at
        assert {type(r[mine]) for r in rows} == {type(r[theirs]) for r in want}, c
