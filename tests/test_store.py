"""Versions as manifests: what a refresh writes, writers at once, columns, key answers, indexes, scans."""

import json
import os

import pytest
from pyspark.sql import functions as F

from mirrorsmith.operators import incremental as inc
from mirrorsmith.operators import merge as mg
from mirrorsmith.operators import quality as qa
from mirrorsmith.plans import refresh as rf
from mirrorsmith.plans import store as st
from mirrorsmith.sources import odata, pages as pg
from mirrorsmith.streaming import keyed_refresh as kr
from tests.test_refresh_stream import DESC, _answer, _pages, _responses, g, row

N = 40


def files(store, part="rows", table=DESC.table):
    base = f"{store.root}/{table}/{part}"
    return {os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


def buckets(paths):
    return [p.split("/b=")[1].split("/")[0] for p in paths]


@pytest.fixture()
def store(spark, scratch):
    s = st.MirrorStore(spark, scratch + "/store")
    rf.refresh_and_commit(s, DESC, _pages(spark, [row(i) for i in range(N)], 100))
    return s


def rows(store):
    return {r["Ссылка"]: (r["ВерсияДанных"], r["Наименование"]) for r in store.read(DESC.table).collect()}


def test_full_refresh_writes_changed_buckets_alone(spark, store):
    had = files(store)
    same = rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(N)], 100))
    assert (same["same"], same["row_count"], same["buckets_written"]) == (N, N, 0) and files(store) == had
    src = [row(i, "2", "new") if i == 3 else row(i) for i in range(N)]
    one = rf.refresh_and_commit(store, DESC, _pages(spark, src, 100))
    fresh = files(store) - had
    assert (one["update"], one["same"], one["buckets_written"]) == (1, N - 1, 1) and len(set(buckets(fresh))) == 1
    assert rows(store) == {g(i): ("2", "new") if i == 3 else ("1", f"item{i}") for i in range(N)}
    assert len(store.read(DESC.table, version=1).collect()) == N and store.current_version(DESC.table) == 3


def test_keyed_refresh_writes_the_buckets_of_its_keys(spark, store):
    had = files(store)
    kr.apply_batch(store, DESC, _responses(spark, _answer(1, row(1, "2", "up")), _answer(2), _answer(99, row(99))))
    fresh = files(store) - had
    assert 0 < len(set(buckets(fresh))) <= 3
    want = {g(i): ("1", f"item{i}") for i in range(N) if i != 2} | {g(1): ("2", "up"), g(99): ("1", "item99")}
    assert rows(store) == want and store.manifest(DESC.table)["row_count"] == len(want)


def test_answers_keep_their_order_across_batches(spark, store):
    kr.apply_batch(store, DESC, _responses(spark, _answer(1, row(1, "5", "five"), seq=5), _answer(2, seq=6), _answer(3, row(3, "1", "three"), seq=3)), stream="s", number=0)
    kr.apply_batch(store, DESC, _responses(spark, _answer(1, row(1, "3", "old"), seq=3), _answer(2, row(2, "4", "back"), seq=4), _answer(3, row(3, "9", "nine"), seq=9)), stream="s", number=1)
    now = rows(store)
    assert now[g(1)] == ("5", "five") and g(2) not in now and now[g(3)] == ("9", "nine")
    version = store.current_version(DESC.table)
    assert kr.apply_batch(store, DESC, _responses(spark, _answer(5)), stream="s", number=1) is None     # a replay
    assert store.current_version(DESC.table) == version
    # a full refresh keeps what is known of the keys; an answer without an order is the latest
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(N)], 100))
    kr.apply_batch(store, DESC, _responses(spark, _answer(2, row(2, "4", "back"), seq=5), _answer(3)), stream="s", number=2)
    now = rows(store)
    assert now[g(2)] == ("1", "item2") and g(3) not in now
    kr.apply_batch(store, DESC, _responses(spark, _answer(2, seq=7)), stream="s", number=3)
    assert g(2) not in rows(store)


def test_two_writers_lose_no_row(spark, store, monkeypatch):
    """A second writer commits between the first one's merge and its manifest."""
    publish, late = st.MirrorStore.publish, []

    def slow(self, table, base, *args, **kw):
        if not late:
            late.append(1)
            kr.apply_batch(st.MirrorStore(spark, store.root), DESC, _responses(spark, _answer(50, row(50))))
        return publish(self, table, base, *args, **kw)

    monkeypatch.setattr(st.MirrorStore, "publish", slow)
    kr.apply_batch(store, DESC, _responses(spark, _answer(51, row(51)), _answer(0)))       # merged again
    assert set(rows(store)) == {g(i) for i in range(1, N)} | {g(50), g(51)}
    late.clear()
    with pytest.raises(st.StaleBase):                                                      # a full load is not
        rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(N)], 100))
    assert g(50) in rows(store)


def test_a_manifest_appears_once(store):
    path = f"{store.root}/{DESC.table}/_versions/77.json"
    assert store._create(path, "one") and not store._create(path, "two")
    assert open(path).read() == "one" and not [n for n in os.listdir(os.path.dirname(path)) if n.endswith("draft")]


def test_versions_and_files_are_bounded(spark, scratch):
    store = st.MirrorStore(spark, scratch + "/store", keep=2)
    for n in range(5):
        rf.refresh_and_commit(store, DESC, _pages(spark, [row(i, str(n)) for i in range(4)], 100))
    assert store.versions(DESC.table) == [4, 5]
    used = {g for v in (4, 5) for g in store.manifest(DESC.table, v)["parts"]["rows"]["generations"]}
    assert {p.split("/rows/")[1].split("/")[0] for p in files(store)} == used


def test_columns_drop_and_rename_without_a_file(spark, store):
    had = files(store)
    store.alter(DESC.table, drop=["Наименование"], rename={"ПометкаУдаления": "Помечен"})
    assert files(store) == had
    now = store.read(DESC.table)
    assert now.columns == ["Ссылка", "ВерсияДанных", "Помечен"] and now.count() == N
    again = now.withColumn("Наименование", F.lit(None).cast("string"))
    before = store.manifest(DESC.table)["parts"]["rows"]
    columns, _ = store._columns(again, before)
    assert {c["name"]: c["id"] for c in columns} == {"Ссылка": 1, "ВерсияДанных": 2, "Помечен": 3, "Наименование": 5}
    # a bucket written with the new column, the others without: nothing old comes back
    part = store.write_part(DESC.table, "rows", again.limit(0), ["Ссылка"], before, touched=[0])
    store.publish(DESC.table, store.current_version(DESC.table), {"rows": part}, 0)
    assert store.read(DESC.table).filter("`Наименование` IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        store.alter(DESC.table, drop=["Ссылка"])


def test_clone_shares_files_and_nothing_else(spark, store, scratch):
    other = st.MirrorStore(spark, scratch + "/other", keep=1)
    store.clone(DESC.table, other)
    kr.apply_batch(other, DESC, _responses(spark, _answer(0)))
    assert len(rows(other)) == N - 1 and len(rows(store)) == N


def test_lookup_reads_the_buckets_of_its_keys(spark, store):
    keys = spark.createDataFrame([(g(1),), (g(1234),)], "`Ссылка` string")
    got = rf.lookup(store, DESC.table, keys, DESC.key)
    assert {r["Ссылка"]: r["Наименование"] for r in got.collect()} == {g(1): "item1", g(1234): None}
    wanted = {str(r[0]) for r in keys.select(st.bucket_of(["Ссылка"], store.buckets(DESC.table))).collect()}
    assert set(buckets(got.inputFiles())) <= wanted


def docs(spark, n, lines):
    data = [(f"k{i:03d}", str(v), [{"f": x} for x in xs]) for i, (v, xs) in enumerate(lines[:n])]
    return spark.createDataFrame(data, "k string, ver string, lines array<struct<f:string>>")


def test_value_index_follows_every_change(spark, scratch):
    store = st.MirrorStore(spark, scratch + "/store")
    lines = [(1, [f"v{i}", "all"]) for i in range(20)]
    rf.commit_changes(store, "T", docs(spark, 20, lines), ["k"], "ver")
    store.create_index("T", "lines", "f")
    find = lambda *want: sorted(r["k"] for r in rf.containing(store, "T", "lines", "f", list(want)).collect())
    assert find("v7") == ["k007"] and find("v7", "all") == ["k007"] and find("none") == [] and len(find("all")) == 20
    n = store.buckets("T")
    assert len(store.buckets_with("T", "lines", "f", ["v7"])) == 1 < n and store.buckets_with("T", "lines", "f", ["none"]) == []
    assert len(set(buckets(rf.containing(store, "T", "lines", "f", ["v7"]).inputFiles()))) == 1
    lines = [(2, ["moved"]) if i == 7 else (1, xs) for i, (_, xs) in enumerate(lines)] + [(1, ["v7"])]
    rf.commit_changes(store, "T", docs(spark, 21, lines).filter("k <> 'k003'"), ["k"], "ver")      # update, insert, delete
    assert find("v7") == ["k020"] and find("moved") == ["k007"] and find("v3") == []
    assert store.buckets_with("T", "lines", "f", ["v3"]) == []


def test_incremental_view_equals_the_view(spark):
    schema = "k long, ver string, grp string, x decimal(20,2)"
    cur = [(i, "1", f"g{i % 4}" if i % 5 else None, None if i % 7 == 0 else i) for i in range(40)] + [(90, "1", "gone", 5)]
    src = [(i, "2", "g9", i * 2) if i % 3 == 0 else (i, v, gr, x) for i, v, gr, x in cur[5:40]] + [(77, "1", "new", None)]
    cur, src = (spark.createDataFrame([(a, b, c, None if d is None else __import__("decimal").Decimal(d)) for a, b, c, d in t], schema) for t in (cur, src))
    sums = {"x": lambda r: r("x")}
    view = inc.grouped(cur, ["grp"], sums)
    after = inc.maintained(view, inc.view_delta(mg.change_set(cur, src, ["k"], "ver"), ["grp"], sums), ["grp"], ["x"])
    want = inc.grouped(src, ["grp"], sums)
    assert sorted(map(repr, after.collect())) == sorted(map(repr, want.select(*after.columns).collect()))
    with pytest.raises(TypeError):
        inc.grouped(cur, ["grp"], {"x": lambda r: r("x").cast("double")})


def test_incremental_sums_keep_their_places(spark):
    from decimal import Decimal
    schema, x = "k long, ver string, grp string, x decimal(38,18)", Decimal("0.000000000000000001")
    cur, src = (spark.createDataFrame([(i, v, "g", x * i) for i in r], schema) for v, r in (("1", range(1, 9)), ("2", range(4, 20))))
    sums = {"x": lambda r: r("x")}
    after = inc.maintained(inc.grouped(cur, ["grp"], sums), inc.view_delta(mg.change_set(cur, src, ["k"], "ver"), ["grp"], sums), ["grp"], ["x"])
    assert after.first()["x"] == x * sum(range(4, 20))


def test_a_refresh_that_would_orphan_rows_makes_no_version(spark, store):
    children = spark.createDataFrame([(1, g(1)), (2, g(2)), (3, None), (4, g(888))], "n int, ref string")
    check = qa.fk_check(children, ["ref"], DESC.key)
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(N) if i != 7], 100), check=check)
    version, had = store.current_version(DESC.table), files(store)
    with pytest.raises(qa.ForeignKeyViolation, match=g(2)):
        rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(N) if i != 2], 100), check=check)
    assert store.current_version(DESC.table) == version and files(store) == had


def test_changed_children_are_checked_too(spark):
    parents = spark.createDataFrame([(i,) for i in range(5)], "id int")
    changes = mg.change_set(parents, parents.filter("id <> 1").union(spark.createDataFrame([(9,)], "id int")), ["id"])
    before = spark.createDataFrame([(1, 0), (2, 1), (3, 7)], "n int, ref int")
    after = spark.createDataFrame([(1, 0), (2, 1), (3, 7), (4, 9), (5, 8), (6, None)], "n int, ref int")
    bad = qa.deferred_fk_violations(after, ["ref"], changes, ["id"], parents, mg.change_set(before, after, ["n"]))
    # 3 was an orphan before and is not touched
    assert sorted(r["n"] for r in bad.collect()) == [2, 5]


def landed(scratch, spark, n, fetch):
    """Responses of a source of n rows, with empty ones behind the end, as it would answer."""
    folder = os.path.join(scratch, f"src{n}-{fetch}")
    os.makedirs(os.path.join(folder, "E"))
    step = (fetch + 1) // 2
    for page in range(0, n // step + 200):
        body = {"value": [{"Ref_Key": g(i)} for i in range(page * step, min(n, page * step + fetch))]}
        with open(os.path.join(folder, "E", f"{page * step}.json"), "w") as f:
            json.dump(body, f)
    return folder


@pytest.mark.parametrize("n,expected", [(0, None), (0, 500), (7, 70), (70, 7), (70, None), (10, 10)])
def test_scan_of_unknown_length(spark, scratch, n, expected):
    base = landed(scratch, spark, n, 4)
    options = {"base_url": "file://" + base, "entity": "E", "fetch_size": "4", "pages_per_partition": "3"}
    pages = odata.scan(spark, options, scratch + "/pages", expected)
    pg.check_page_set(pages)
    got = [r[0] for r in pages.selectExpr("explode(from_json(body, 'value array<struct<Ref_Key:string>>').value.Ref_Key)").collect()]
    assert set(got) == {g(i) for i in range(n)}
    assert pages.count() == odata._page_count(n, 4)


def test_no_task_leaves_its_range():
    reader = odata.PagedReader({"base_url": "file:///none", "entity": "E", "fetch_size": "4", "pages_per_partition": "3", "first_page": "6", "last_page": "13"})
    asked = []
    reader.page = lambda k: asked.append(k) or ("{}", k, 4)
    assert [(p.first, p.last) for p in reader.partitions()] == [(6, 8), (9, 11), (12, 13)]
    assert len(list(reader.read(reader.partitions()[2]))) == 2 and asked == [12, 13]


def test_missing_response_is_no_end(spark, scratch):
    base = landed(scratch, spark, 20, 4)
    os.remove(os.path.join(base, "E", "6.json"))
    options = {"base_url": "file://" + base, "entity": "E", "fetch_size": "4", "pages_per_partition": "3"}
    with pytest.raises(pg.IncompleteLoad, match="page 3: no response"):
        odata.scan(spark, options, scratch + "/pages", 20)


def test_queries_need_no_root_of_their_own(spark, monkeypatch):
    """Off local no root is set for a query's views; they lie beside the mirror of their inputs."""
    from mirrorsmith.plans import queries, store as st

    def unset(_):
        raise RuntimeError("no root")
    monkeypatch.setattr(st, "mirror_root", unset)
    sf = "/root/testdata/sf0.001"
    counts = queries.enum_counts(spark, sf)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert {(r["ref"], r["n_orders"]) for r in counts.collect()} == {tuple(r) for r in orders.groupBy("o_orderpriority").count().collect()}
    assert queries.materialized_view(spark, sf).count() == queries.VIEW_LIMIT
