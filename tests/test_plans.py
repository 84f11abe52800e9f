"""Plan properties that the scale design relies on (checked on executed plans)."""

import re

import pytest

from mirrorsmith.plans import queries as q
from mirrorsmith.sources import tables as tb

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(q.REGISTRY))
def test_no_pairwise_joins(spark, name):
    plan = _plan(q.REGISTRY[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_refresh_exchanges_only_the_load(spark):
    plan = _plan(q.document_mirror(spark, SF))
    join = plan[plan.index("SortMergeJoin"):]
    # stored side: a bucketed scan with no exchange; load side: one exchange by key
    assert "Bucketed: true" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(Ссылка", join)) == 1
    # the dedup reduces hot keys before the shuffle
    assert "WindowGroupLimit" in plan and ", Partial" in plan


def test_page_bodies_parsed_once(spark):
    plan = _plan(q.document_mirror(spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "body" in line]
    assert scan and all("from_json" not in line for line in scan)


def test_section_view_parses_once(spark):
    # explode over a decoded column must not copy the decode into a filter
    plan = _plan(q.explode_section(spark, SF))
    assert "from_json" not in plan


def test_flat_section_refresh_exchanges_only_the_load(spark):
    plan = _plan(q.section_entity_refresh(spark, SF))
    join = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(Ссылка#\d+, НомерСтроки", join)) == 1


def test_report_reads_only_its_columns(spark):
    # master key, version, customer and lines of the stored side; no other column
    plan = _plan(q.section_sales_topk(spark, SF))
    stored = next(line for line in plan.splitlines() if "FileScan parquet" in line and "Bucketed: true" in line)
    read = re.search(r"\[(.*?)\]", stored.split("FileScan parquet")[1])[1]
    # files name their columns by number, in the order of the description; b is the bucket
    names = {f"c{i}": c.name for i, c in enumerate(tb.document_description(spark).columns, 1)} | {"b": "b"}
    assert {names[re.sub(r"#.*", "", c)] for c in read.split(",")} == {"Ссылка", "ВерсияДанных", "Покупатель", "Товары", "b"}
