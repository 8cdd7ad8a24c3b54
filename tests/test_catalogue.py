"""Every query with SQL against DuckDB over the smallest tables; every other one runs."""

import glob
import math
import os

import pytest

from sparkmill.plans import catalogue


def canon(rows, cols):
    at = sorted(range(len(cols)), key=lambda i: cols[i])
    clean = lambda v: (None if math.isnan(v) else round(v, 5)) if isinstance(v, float) else v
    return sorted((tuple(clean(r[i]) for i in at) for r in rows), key=repr)


@pytest.fixture(scope="session")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_as_sql(spark, sf, duck, name):
    got = catalogue.QUERIES[name](spark, sf)
    cur = duck.execute(catalogue.ORACLE_SQL[name])
    want = cur.fetchall()
    cols = [c[0] for c in cur.description]
    assert sorted(got.columns) == sorted(cols)
    assert canon([tuple(r) for r in got.collect()], got.columns) == canon(want, cols)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() >= 0


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
