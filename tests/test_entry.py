"""Driver contract: entry() smoke test and every registered query against
its DuckDB oracle on the smallest scale factor."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "article_id" in df.columns


def test_every_query_has_a_builder():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 90


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in sdf.collect())
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = sorted(repr(tuple(norm(r[i]) for i in idx)) for r in cur.fetchall())
    assert cols == sorted(dcols)
    assert srows == drows
