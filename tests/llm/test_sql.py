"""Queries with SQL against DuckDB over the same whole tables."""

import duckdb
import pytest

from posefold.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    got = QUERIES[name](spark, SF)
    base = duckdb.connect()
    for table in TABLES:
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = base.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda table: sorted(map(repr, table))
    assert rows(map(tuple, got.select(*columns).collect())) == rows(want.project(", ".join(columns)).fetchall())
