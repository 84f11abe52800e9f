"""Paging, first-arrival dedup and merge properties."""

import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import pytest

from mirrorsmith.fixtures import source as fx
from mirrorsmith.operators import merge as mg
from mirrorsmith.operators.dedup import first_arrival
from mirrorsmith.operators.ordinal import with_ordinal
from mirrorsmith.sources import pages as pg


def _pages_by_loop(n: int, f: int) -> list[tuple[int, int]]:
    """The source's own loop: request pages until one is short."""
    out, skip, k = [], 0, 0
    while True:
        rows = max(0, min(f, n - skip))
        out.append((skip, rows))
        if rows < f:
            return out
        skip += (f + 1) // 2
        k += 1


def _page_count(n: int, f: int) -> int:
    h = (f + 1) // 2
    return 1 if n < f else (n - f) // h + 2


@given(st.integers(min_value=0, max_value=5000), st.integers(min_value=1, max_value=700))
@settings(max_examples=300, deadline=None)
def test_page_count_formula_matches_loop(n, f):
    pages = _pages_by_loop(n, f)
    assert len(pages) == _page_count(n, f)
    covered = set()
    for skip, rows in pages:
        covered.update(range(skip, skip + rows))
    assert covered == set(range(n))             # every row at least once


def test_plan_requests_matches_formula(spark):
    tables = spark.createDataFrame(
        [("A", "Catalog_A", "Ref_Key", f, n) for n in (0, 1, 9, 10, 11, 99, 1000) for f in (1, 2, 10, 33)],
        "table string, entity string, sort string, fetch_size int, row_count long")
    req = pg.plan_requests(tables)
    got = {(r["row_count"], r["fetch_size"]): r["n"] for r in
           req.groupBy("row_count", "fetch_size").agg(F.count(F.lit(1)).alias("n")).collect()}
    for (n, f), c in got.items():
        assert c == _page_count(n, f)
    url = req.filter("row_count = 99 and fetch_size = 10 and page_no = 2").first()["url"]
    assert url == "/InfoBase/odata/standard.odata/Catalog_A?$orderby=Ref_Key&$skip=10&$top=10"


def test_ordinal_is_consecutive(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k"))
    got = with_ordinal(df, ["k"], "n", buckets=16).orderBy("k").select("k", "n").collect()
    assert [r["n"] for r in got] == list(range(5000))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)


def test_land_read_dedup_roundtrip(spark, scratch):
    rows = spark.range(0, 237).select(F.col("id").alias("k"),
                                      F.to_json(F.struct(F.col("id").alias("K"), F.lit("v").alias("V"))).alias("json"))
    numbered = with_ordinal(rows, ["k"], "n")
    altered = lambda j: F.regexp_replace(j, '"V":"v"', '"V":"later"')
    pages = fx.land_pages(numbered, "json", "n", 20, "T", later_copy=altered)
    assert pages.count() == _page_count(237, 20)
    pg.write_pages(pages, scratch + "/landed")
    landed = pg.read_landed(spark, scratch + "/landed")
    read = pg.read_pages(landed, spark.createDataFrame([], "K long, V string").schema)
    assert read.count() > 237                    # overlap: copies arrive twice
    first = first_arrival(read.select("page_no", "pos", "row.*"), ["K"])
    got = {r["K"]: r["V"] for r in first.collect()}
    assert len(got) == 237 and set(got.values()) == {"v"}


CUR = [(1, "a", "v1"), (2, "b", "v1"), (3, "c", "v1"), (4, None, "v1")]
SRC = [(2, "B", "v2"), (3, "C", "v1"), (4, None, "v1"), (5, "e", "v1")]
SCHEMA = "k int, x string, ver string"


def test_merge_by_version(spark):
    cur, src = spark.createDataFrame(CUR, SCHEMA), spark.createDataFrame(SRC, SCHEMA)
    got = {r["k"]: (r["x"], r["action"]) for r in mg.merge_full(cur, src, ["k"], "ver", with_action=True).collect()}
    # 3 changed without a new version: kept as it was
    assert got == {2: ("B", "update"), 3: ("c", "same"), 4: (None, "same"), 5: ("e", "insert")}


def test_merge_by_value_equals_source_and_is_idempotent(spark):
    cur, src = spark.createDataFrame(CUR, SCHEMA), spark.createDataFrame(SRC, SCHEMA)
    merged = mg.merge_full(cur, src, ["k"])
    assert sorted(merged.collect()) == sorted(src.collect())
    again = mg.change_counts(mg.change_set(merged, src, ["k"]))
    assert {r["action"]: r["n_rows"] for r in again.collect()} == {"same": 4}
    counts = {r["action"]: r["n_rows"] for r in mg.change_counts(mg.change_set(cur, src, ["k"])).collect()}
    assert counts == {"delete": 1, "update": 2, "same": 1, "insert": 1}
    assert sum(counts.values()) == len({r[0] for r in CUR} | {r[0] for r in SRC})


def test_inserts_deletes_refresh_by_key(spark):
    cur, src = spark.createDataFrame(CUR, SCHEMA), spark.createDataFrame(SRC, SCHEMA)
    assert [r["k"] for r in mg.inserts(cur, src, ["k"]).collect()] == [5]
    assert [r["k"] for r in mg.deletes(cur, src, ["k"]).collect()] == [1]
    keys = spark.createDataFrame([(1,), (2,), (2,), (9,)], "k int")
    got = sorted(tuple(r) for r in mg.refresh_by_key(cur, src, keys, ["k"]).collect())
    assert got == [(2, "B", "v2"), (3, "c", "v1"), (4, None, "v1")]


def test_enum_merge(spark):
    existing = spark.createDataFrame([("a", 3), ("old", 7), ("b", 1)], "ref string, ord long")
    members = spark.createDataFrame([("b", 1), ("c", 2), ("a", 3), ("d", 4)], "ref string, pos long")
    got = dict((r["ref"], r["ord"]) for r in mg.enum_merge(existing, members).collect())
    assert got == {"a": 3, "b": 1, "c": 8, "d": 9}


def test_first_arrival_hot_key(spark):
    # one key holds most rows: partial aggregation reduces it before the shuffle
    df = spark.range(0, 20000).select(F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      F.floor(F.col("id") / 100).cast("int").alias("page_no"),
                                      (F.col("id") % 100).cast("int").alias("pos"), F.col("id").alias("v"))
    got = first_arrival(df, ["k"])
    assert got.filter("k = 0").first()["v"] == 0
    assert got.count() == 1 + 4000
    assert json.loads(got.filter("k = 0").select(F.to_json(F.struct("page_no", "pos"))).first()[0]) == \
        {"page_no": 0, "pos": 0}


def test_read_response_files(spark, scratch):
    import os
    os.makedirs(scratch + "/resp")
    bodies = {0: [{"K": 1, "V": "a"}, {"K": 2, "V": "b"}], 1: [{"K": 2, "V": "later"}, {"K": 3, "V": "c"}]}
    for page, rows in bodies.items():
        with open(f"{scratch}/resp/{page}.json", "w") as f:
            f.write(json.dumps({"value": rows}) + "\n")
    landed = pg.read_response_files(spark, scratch + "/resp", "T")
    read = pg.read_pages(landed, spark.createDataFrame([], "K long, V string").schema)
    first = first_arrival(read.select("page_no", "pos", "row.*"), ["K"])
    assert sorted((r["K"], r["V"], r["page_no"]) for r in first.collect()) == [(1, "a", 0), (2, "b", 0), (3, "c", 1)]


def test_ordinal_with_hot_first_value(spark):
    # 60% of the rows share one first-column value; the second column splits them
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 10 < 6, F.lit(7)).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    got = with_ordinal(df, ["a", "b"], "n", buckets=8).orderBy("n").select("a", "b", "n").collect()
    assert [r["n"] for r in got] == list(range(6000))
    assert [(r["a"], r["b"]) for r in got] == sorted((r["a"], r["b"]) for r in got)


@pytest.mark.parametrize("value", [None, 5, "mixed"])
def test_ordinal_with_null_and_constant_values(spark, value):
    """NULLs first, and a constant column is no single range."""
    rows = [((None if i % 10 == 0 else i % 3) if value == "mixed" else value, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = with_ordinal(df, ["a", "b"], "n", buckets=7, total_name="t").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["n"])] == want
    assert {r["t"] for r in got} == {1000}
    alone = with_ordinal(df, ["a"], "n", buckets=7).collect()
    assert sorted(r["n"] for r in alone) == list(range(1000))
    assert [r["a"] for r in sorted(alone, key=lambda r: r["n"])] == [a for a, _ in want]


def test_ordinal_on_text(spark):
    df = spark.createDataFrame([(f"k{i:05d}",) for i in range(500)], "k string")
    got = with_ordinal(df, ["k"], "n", buckets=4).orderBy("n").collect()
    assert [r["k"] for r in got] == sorted(r["k"] for r in got) and got[-1]["n"] == 499


def test_live_source_reads_page_ranges(spark, scratch):
    import os
    from mirrorsmith.sources.odata import PagedSource
    rows = spark.range(0, 23).select(F.col("id").alias("n"),
                                     F.to_json(F.struct(F.col("id").alias("K"))).alias("json"))
    landed = {r["page_no"]: (r["skip"], r["body"]) for r in fx.land_pages(rows, "json", "n", 4, "E").collect()}
    os.makedirs(f"{scratch}/src/E")
    for skip, body in landed.values():
        with open(f"{scratch}/src/E/{skip}.json", "w") as f:
            f.write(body)
    spark.dataSource.register(PagedSource)

    def read(first, last):
        return (spark.read.format("mirror_pages").option("base_url", f"file://{scratch}/src").option("entity", "E")
                .option("fetch_size", 4).option("first_page", first).option("last_page", last).option("pages_per_partition", 3).load())

    got = read(0, max(landed))
    assert got.rdd.getNumPartitions() == 4
    assert {r["page_no"]: (r["skip"], r["body"]) for r in got.collect()} == landed
    assert {r["page_no"] for r in read(4, 6).collect()} == {4, 5, 6}
    keys = read(0, max(landed)).transform(lambda p: pg.read_pages(p, spark.createDataFrame([], "K long").schema))
    assert first_arrival(keys.select("page_no", "pos", "row.*"), ["K"]).count() == 23


def test_large_bodies_land_in_small_groups(spark, scratch):
    """A reader takes a group's rows at once, so no group holds many large bodies."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    from mirrorsmith.sources import pages as pg

    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda i: F.sha2((F.col("id") * 10_000 + i).cast("string"), 256)), "")
    made = spark.range(0, 80, 1, 1).select(F.lit("T").alias("table"), F.col("id").cast("int").alias("page_no"), F.col("id").alias("skip"), body.alias("body"))
    pg.write_pages(made, f"{scratch}/landed")
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{scratch}/landed/**/*.parquet", recursive=True)]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 80 and max(g.total_byte_size for g in groups) < 8 << 20
    assert pg.read_landed(spark, f"{scratch}/landed").exceptAll(made).count() == 0


def test_keyed_refresh_sorts_no_rows(spark):
    from mirrorsmith.operators import merge as mg

    cur = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "a"), (4, "a")], "k int, v string")
    src = spark.createDataFrame([(1, "n"), (2, "n"), (5, "n"), (None, "n")], "k int, v string")
    keys = spark.createDataFrame([(2,), (2,), (4,), (5,), (None,)], "k int")
    out = mg.refresh_by_key(cur, src, keys, ["k"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "a"), (None, "a"), (2, "n"), (5, "n")], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
