"""Registered queries against their SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from mirrorsmith.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_every_operator_is_registered():
    got = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert got == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.REGISTRY[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    norm = lambda v: repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v)
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(map(norm, r)) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_no_pairwise_joins(spark, name):
    plan = queries.REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
