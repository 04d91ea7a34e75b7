"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from bisque import queries as engine

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(engine.ORACLES))
def test_same_rows(spark, duck, name):
    df = engine.QUERIES[name](spark, SF)
    cur = duck.execute(engine.ORACLES[name])
    cols = [x[0] for x in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
