"""Queries of the subpackage that SQL can express, against DuckDB."""

import duckdb
import pytest

from retalia.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for given in ("documents", "embeddings", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {given} AS SELECT * FROM '{SF}/{given}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.select(*order).fetchall())
