"""Every registered query with SQL against DuckDB, as the driver compares them: rows sorted, columns by name."""

import os

import duckdb
import pytest

from partloom import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Sums, shares and ranks are compared on a larger table, too: what depends on the order of sums shows there.
LARGER = os.environ.get("TEST_LARGER_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    return round(v, 9) + 0.0 if isinstance(v, float) else v  # beyond the digits of any query: a difference in its last digit shows


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    def connect(sf):
        c = duckdb.connect()
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        return c

    return {sf: connect(sf) for sf in (SF, LARGER)}


CASES = [(SF, name) for name in sorted(registry.queries())] + [(LARGER, name) for name in sorted(registry.oracle_sql()) if name[0] in "aw"]


@pytest.mark.parametrize("sf,name", CASES, ids=lambda x: os.path.basename(x))
def test_query(spark, duck, sf, name):
    got = registry.queries()[name](spark, sf)
    rows = [tuple(r) for r in got.collect()]
    assert rows, "no rows"
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    want = duck[sf].execute(sql)
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted_rows(got.columns, rows) == sorted_rows(columns, want.fetchall())
