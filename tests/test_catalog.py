"""Every query of the engine against its SQL on the smallest tables."""

import math
import os

import pytest

from quillgrid.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.sql(sql)
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    pick = lambda names, data: sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in data)
    assert pick(df.columns, rows) == pick(want.columns, want.fetchall())


def test_entry_survives_without_extras(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns
