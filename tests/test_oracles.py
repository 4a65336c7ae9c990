"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import math
import os

import pytest

from clipspans.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
TABLES = ("events", "conversations", "documents", "pages", "labels", "benchmark")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r])


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    mine, theirs = as_rows(got.columns, [tuple(r) for r in got.collect()]), as_rows(columns, want.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in registry.oracle_sql()])
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() >= 0
