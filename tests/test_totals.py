"""Order totals whose double has more than ten decimal places after the source's change."""

import datetime as dt
import os

import pytest

from mirrorsmith.plans import queries

PRICE = 131071.02        # 131071.02 + 1 is 131072.02000000002


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("totals"))
    day = dt.datetime(2020, 1, 2)
    orders = [(k, k % 3, "OFP"[k % 3], PRICE if k % 10 == 2 else 10.5 * k, day, "1-URGENT") for k in range(25)]
    lines = [(k, n, k + n, 1, 2.0, 3.25 * n, 0.1, 0.0, "R", "O", day) for k in range(25) for n in (1, 2)]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


@pytest.mark.parametrize("name", ["refresh_by_key_documents", "key_answers_in_batches", "lookup_join"])
def test_changed_totals_arrive_whole(spark, made, name):
    rows = queries.REGISTRY[name](spark, made).collect()
    key = "l_orderkey" if name == "lookup_join" else "o_orderkey"
    assert {r["o_totalprice"] for r in rows if r[key] % 10 == 2} == {PRICE + 1}


def test_refresh_to_changed_totals(spark, made):
    first = queries.refresh_counts(spark, made).orderBy("run").first()
    assert (first["n_insert"], first["n_update"], first["n_delete"], first["row_count"]) == (3, 3, 3, 22)
    hits = queries.section_contains_indexed(spark, made).collect()
    assert [r["o_orderkey"] for r in hits] == [24]


def test_view_of_changed_totals(spark, made):
    kept = {k: PRICE + 1 if k % 10 == 2 else 10.5 * k for k in range(25) if k % 10 != 1}
    want = {c: round(sum(t for k, t in kept.items() if k % 3 == c), 2) for c in range(3)}
    assert {r["customer"]: r["total"] for r in queries.sales_view_refresh(spark, made).collect()} == want
