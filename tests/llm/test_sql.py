"""The queries that have SQL, against DuckDB on the smallest tables, as the driver compares them."""

import os

import duckdb
import pytest

from partloom.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = c.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
