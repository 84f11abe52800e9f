"""Snapshots, views, audit rows, SQL table functions and the keyed-refresh stream."""

import json
import os

import pytest

from mirrorsmith.fixtures import source as fx
from mirrorsmith.plans import refresh as rf
from mirrorsmith.plans.description import ColumnDesc, TableDescription
from mirrorsmith.sources import pages as pg
from mirrorsmith.streaming import keyed_refresh as kr

DESC = TableDescription(
    table="Справочник.Товары", kind="Catalog", entity="Catalog_Товары",
    columns=[ColumnDesc("Ref_Key", "Edm.Guid", "Ссылка", "uuid"),
             ColumnDesc("DataVersion", "Edm.String", "ВерсияДанных", "text"),
             ColumnDesc("DeletionMark", "Edm.Boolean", "ПометкаУдаления", "bool"),
             ColumnDesc("Description", "Edm.String", "Наименование", "text")],
    key=["Ссылка"], sort=["Ref_Key"], version="ВерсияДанных")


def g(i):
    return "a0000000-0000-0000-0000-%012x" % i


def row(i, ver="1", name=None, deleted=False):
    return {"Ref_Key": g(i), "DataVersion": ver, "DeletionMark": deleted, "Description": name or f"item{i}"}


def _pages(spark, rows, fetch):
    df = spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)], "n long, json string")
    return fx.land_pages(df, "json", "n", fetch, DESC.entity)


def test_full_refresh_versions_and_views(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    s1 = rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(7)], 4))
    assert s1["insert"] == 7 and s1["row_count"] == 7 and s1["version"] == 1
    src2 = [row(0, "2", "renamed")] + [row(i) for i in range(1, 5)] + [row(9)]
    s2 = rf.refresh_and_commit(store, DESC, _pages(spark, src2, 4))
    assert (s2["insert"], s2["update"], s2["delete"], s2["same"]) == (1, 1, 2, 4)
    assert store.current_version(DESC.table) == 2
    store.register(DESC.table, DESC)
    got = dict(spark.sql("SELECT `Ссылка`, `Наименование` FROM `Справочник.Товары`").collect())
    assert got[g(0)] == "renamed" and len(got) == 6
    # the previous version is untouched
    assert store.read(DESC.table, version=1).count() == 7


def test_sql_table_function_over_mirror(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(i, deleted=i % 2 == 0) for i in range(6)], 10))
    store.register(DESC.table, DESC)
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION live_items(skip_deleted BOOLEAN)
                 RETURNS TABLE (ref STRING, name STRING)
                 RETURN SELECT `Ссылка`, `Наименование` FROM `Справочник.Товары`
                        WHERE NOT (skip_deleted AND `ПометкаУдаления`)""")
    assert spark.sql("SELECT count(*) FROM live_items(true)").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM live_items(false)").first()[0] == 6


def test_audit_rows_mask_password(spark, scratch):
    tables = spark.createDataFrame([("T", "Catalog_T", "Ref_Key", 10, 25)],
                                   "table string, entity string, sort string, fetch_size int, row_count long")
    rows = rf.audit_requests(pg.plan_requests(tables), "http://odata:s3cret@10.0.0.1:80", "DEFAULT", "tester")
    urls = [r["url"] for r in rows.collect()]
    assert len(urls) == 5 and all("s3cret" not in u and "odata:[Пароль]@" in u for u in urls)
    store = rf.MirrorStore(spark, scratch + "/store")
    rf.append_audit(store, rows)
    rf.append_audit(store, rows)
    assert spark.read.parquet(f"{store.root}/_audit/requests").count() == 10


def test_keyed_refresh_stream(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(5)], 10))
    landed = os.path.join(scratch, "landed")
    os.makedirs(landed)
    responses = [
        {"keys": {"Ref_Key": g(1)}, "value": [row(1, "2", "changed")]},   # found: upsert
        {"keys": {"Ref_Key": g(2)}, "value": []},                           # gone: delete
        {"keys": {"Ref_Key": g(7)}, "value": [row(7)]},                     # new at the source
    ]
    with open(os.path.join(landed, "batch1.json"), "w", encoding="utf-8") as f:
        for r in responses:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")
    q = kr.start(spark, landed, DESC, store, checkpoint=scratch + "/stream-ckpt")
    q.awaitTermination(120)
    snap = {r["Ссылка"]: r["Наименование"] for r in store.read(DESC.table).collect()}
    assert snap == {g(0): "item0", g(1): "changed", g(3): "item3", g(4): "item4", g(7): "item7"}


def test_create_table_then_refresh(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    assert rf.create_table(store, DESC) == 1
    assert rf.create_table(store, DESC) == 1                 # already there
    assert spark.sql("SELECT count(*) FROM `Справочник.Товары`").first()[0] == 0
    stats = rf.refresh_and_commit(store, DESC, _pages(spark, [row(i) for i in range(3)], 2))
    assert stats["version"] == 2 and stats["insert"] == 3


def test_enum_order_checks(spark):
    from mirrorsmith.operators.quality import enum_order_checks
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", None)], "`Ссылка` string, `Порядок` long")
    assert sorted(r["Ссылка"] for r in enum_order_checks(df).collect()) == ["b", "c", "d"]


def test_failed_write_is_no_version(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    store.commit("T", spark.range(3))
    store.write_part("T", "rows", spark.range(9), None)      # a writer that died before its manifest
    open(f"{store.root}/T/_versions/2.json.1234.draft", "w").close()   # ... or before it was whole
    assert store.current_version("T") == 1 and store.read("T").count() == 3
    version, rows = store.commit("T", spark.range(5))
    assert (version, rows) == (2, 5) and store.current_version("T") == 2 and store.read("T").count() == 5


def test_select_refresh_fast_skips_unknown_sizes(spark):
    ctl = spark.createDataFrame([("DEFAULT", "b", "Catalog", 10, 5), ("DEFAULT", "a", "Catalog", 10, None),
                                 ("DEFAULT", "c", "Catalog", 10, 50), ("DEFAULT", "e", "Enumeration", 10, 1)],
                                "server string, table string, kind string, fetch_size int, row_count long")
    assert [r["table"] for r in rf.select_refresh(ctl).collect()] == ["a", "b", "c"]
    assert [r["table"] for r in rf.select_refresh(ctl, fast=True).collect()] == ["b"]


def _responses(spark, *answers):
    return spark.createDataFrame([(json.dumps(a, ensure_ascii=False),) for a in answers], "value string").coalesce(1)


def _answer(i, *rows, **more):
    return {"keys": {"Ref_Key": g(i)}, "value": list(rows), **more}


def test_last_response_of_a_key_counts(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(1), row(2), row(3), row(4)], 10))
    current = store.read(DESC.table)
    batch = _responses(spark, _answer(1, row(1, "2", "first")), _answer(1, row(1, "3", "second")),
                       _answer(2, row(2, "2", "upsert")), _answer(2),                      # then deleted
                       _answer(3), _answer(3, row(3, "2", "back")),                       # deleted, then there again
                       _answer(9, row(9, "1", "new"), seq=5), _answer(9, seq=7), _answer(9, row(9, "2", "late"), seq=6))
    out = kr.apply_responses(batch, DESC, current)
    assert {r["Ссылка"]: r["Наименование"] for r in out.collect()} == {g(1): "second", g(3): "back", g(4): "item4"}
    assert out._jdf.queryExecution().executedPlan().toString().count("from_json") <= 2     # one parse (and its name)


def test_unreadable_response_stops_the_batch(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(1)], 10))
    for bad in ('{"keys": {"Ref_Key"', '{"value": []}', '{"keys": {"Ref_Key": "%s"}}' % g(1)):
        with pytest.raises(Exception):
            kr.apply_responses(spark.createDataFrame([(bad,)], "value string"), DESC, store.read(DESC.table)).collect()


def test_response_with_two_rows_stops_the_batch(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    rf.refresh_and_commit(store, DESC, _pages(spark, [row(1)], 10))
    current = store.read(DESC.table)
    with pytest.raises(Exception, match="a key response has 2 rows"):
        kr.apply_responses(_responses(spark, _answer(1, row(1, "2", "one"), row(1, "3", "two"))), DESC, current).collect()
    out = kr.apply_responses(_responses(spark, _answer(1, row(1, "2", "one"))), DESC, current)
    assert [r["Наименование"] for r in out.collect()] == ["one"]
