"""Every registered query with an oracle, run on sf0.001 and compared row for row with DuckDB."""

import math
import os

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ["supplier", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return "None" if v is None else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _names():
    from shelfcast.queries import ORACLE
    return sorted(ORACLE)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from shelfcast.queries import ORACLE, QUERIES
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    a = sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    b = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.count() >= 1
    assert set(ent.oracle_sql()) <= set(ent.queries())
