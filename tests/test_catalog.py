"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import os

import duckdb
import pytest

from versegrid.plans import corpora, lookups, more, passages, stores  # noqa: F401
from versegrid.plans.catalog import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    if name not in ORACLES:
        assert got
        return
    said = duck.execute(ORACLES[name])
    order = [[d[0] for d in said.description].index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in said.fetchall()]
    assert sorted(map(str, got)) == sorted(map(str, want))
