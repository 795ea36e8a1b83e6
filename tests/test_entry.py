"""The driver contract, checked against DuckDB on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from clickscope.plans import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]
    assert df.count() == 10


def test_every_query_has_an_oracle():
    assert set(all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _bag(rows, df.columns) == _bag(res.fetchall(), cols)
