"""Driver contract: smoke of `entry`, and every registered query against its
SQL oracle on the smallest tables (brute force on a small fixture)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from mirrorsmith.plans.queries import REGISTRY
from mirrorsmith.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["customer", "brand", "sales"]


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = sorted(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want
