"""Every registered query against its DuckDB statement on sf0.001 (the
driver runs the same comparison at sf0.01; see check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    expect = rows_of([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert rows_of(df.collect()) == expect
