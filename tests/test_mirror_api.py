"""The Mirror workflow end to end on the metadata fixture."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from mirrorsmith.fixtures import source as fx
from mirrorsmith.plans import refresh as rf
from mirrorsmith.plans.mirror import MissingAnswers, Mirror
from mirrorsmith.sources import pages as pg
from tests.test_catalog import METADATA

T = "Справочник.Контрагенты"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def g(i):
    return "a0000000-0000-0000-0000-%012x" % i


def doc(i, ver="1", country="РОССИЯ"):
    return {"Ref_Key": g(i), "DataVersion": ver, "DeletionMark": False, "Description": f"c{i}",
            "Менеджер": "m", "Менеджер_Type": "StandardODATA.Catalog_Сотрудники", "Фото_Base64Data": "",
            "КонтактнаяИнформация": [{"LineNumber": "1", "Страна": country}]}


def pages(spark, docs, fetch=2):
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)],
                               "n long, json string")
    return fx.land_pages(df, "json", "n", fetch, "Catalog_Контрагенты")


def test_mirror_workflow(spark, scratch):
    meta = os.path.join(scratch, "meta.xml")
    with open(meta, "w", encoding="utf-8") as f:
        f.write(METADATA)
    m = Mirror(spark, meta, root=scratch + "/mirror")
    assert [r["table"] for r in m.list_objects().collect()] == [
        "Перечисление.ТипыНоменклатуры", "РегистрНакопления.Остатки", "Справочник.Контрагенты"]

    assert m.create_table(T) == 1
    assert spark.sql("SELECT count(*) FROM `Справочник.Контрагенты`").first()[0] == 0

    stats = m.refresh(T, pages(spark, [doc(1), doc(2), doc(3)]))
    assert stats["insert"] == 3 and stats["row_count"] == 3
    ctl = m.control().filter(F.col("table") == T).first()
    assert ctl["row_count"] == 3 and ctl["kind"] == "Catalog"

    assert spark.sql(f"SELECT count(*) FROM `{T}`").first()[0] == 3
    assert spark.sql(f"SELECT count(*) FROM `{T}_КонтактнаяИнформация`").first()[0] == 3

    keys = spark.createDataFrame([(g(1),), (g(2),)], "`Ссылка` string")
    asked = [r["url"] for r in m.key_requests(T, keys).orderBy("url").collect()]
    assert asked == [f"/InfoBase/odata/standard.odata/Catalog_Контрагенты?$filter=Ref_Key%20eq%20guid'{g(i)}'" for i in (1, 2)]
    body = lambda *docs: json.dumps({"value": list(docs)}, ensure_ascii=False)
    answers = spark.createDataFrame([(g(1), body(doc(1, "2", "ГЕРМАНИЯ"))), (g(2), body())], "`Ссылка` string, body string")
    version = m.store.current_version(T)
    for lost in (answers.limit(0), answers.filter(F.col("Ссылка") == g(1)), answers.withColumn("body", F.lit(None).cast("string"))):
        with pytest.raises(MissingAnswers, match="no answer for"):
            m.refresh_keys(T, keys, lost)
    with pytest.raises(Exception):
        m.refresh_keys(T, keys, answers.withColumn("body", F.lit('{"odata.error": {}}')))
    assert m.store.current_version(T) == version and m.table(T).count() == 3
    answer = {r["Ссылка"]: r["ВерсияДанных"] for r in m.refresh_keys(T, keys, answers).collect()}
    assert answer == {g(1): "2", g(2): None}
    assert spark.sql(f"SELECT count(*) FROM `{T}`").first()[0] == 2
    snap = {r["Ссылка"]: r for r in m.table(T).collect()}
    assert set(snap) == {g(1), g(3)}
    assert snap[g(1)]["КонтактнаяИнформация"][0]["Страна"] == "ГЕРМАНИЯ"
    assert snap[g(1)]["КонтактнаяИнформация"][0]["Ссылка"] == g(1)

    done = m.refresh_all(lambda t: pages(spark, [doc(1), doc(4)]), fast=True)
    assert [d["table"] for d in done] == [T] and done[0]["row_count"] == 2

    # the source adds an attribute: the table is emptied for a reload
    with open(meta, "w", encoding="utf-8") as f:
        f.write(METADATA.replace('<Property Name="Description" Type="Edm.String"/>',
                                 '<Property Name="Description" Type="Edm.String"/>\n'
                                 '    <Property Name="ИНН" Type="Edm.String"/>'))
    change = m.refresh_metadata(T, pages(spark, [doc(7)]))
    assert change["reload"] and change["add"] == ["ИНН"]
    assert m.table(T).first()["ИНН"] == ""

    # the same refresh through the live source: responses under file://<dir>/<entity>/<skip>.json
    src = os.path.join(scratch, "source", "Catalog_Контрагенты")
    os.makedirs(src)
    for r in pages(spark, [doc(7), doc(8), doc(9)], fetch=10000).collect():
        with open(os.path.join(src, f"{r['skip']}.json"), "w", encoding="utf-8") as f:
            f.write(r["body"])
    live = m.fetch_pages(T, "file://" + os.path.join(scratch, "source"), user="odata", password="q/zx@yw")
    stats = m.refresh(T, live)
    assert stats["insert"] == 2 and stats["row_count"] == 3
    log = spark.read.parquet(m.store.root + "/_audit/requests").collect()
    assert log and all("zx@" not in r["url"] and "yw@" not in r["url"] and "odata:[Пароль]@" in r["url"] for r in log)


def test_section_entity_as_flat_table(spark, scratch):
    """A large section is mirrored from its own entity set: rows are lines,
    keyed by master key + line number, so a huge document is never one row."""
    from mirrorsmith.operators.sections import nest_lines
    meta = os.path.join(scratch, "meta.xml")
    with open(meta, "w", encoding="utf-8") as f:
        f.write(METADATA)
    m = Mirror(spark, meta, root=scratch + "/mirror")
    sec = "Справочник.Контрагенты_КонтактнаяИнформация"
    d = m.describe(sec)
    assert d.key == ["Ссылка", "НомерСтроки"]
    # one master holds most lines (a hot document)
    lines = [{"Ref_Key": g(1), "LineNumber": str(i), "Страна": f"C{i % 7}"} for i in range(1, 301)]
    lines += [{"Ref_Key": g(2), "LineNumber": "1", "Страна": "X"}]
    df = spark.createDataFrame([(i, json.dumps(x, ensure_ascii=False)) for i, x in enumerate(lines)], "n long, json string")
    stats = m.refresh(sec, fx.land_pages(df, "json", "n", 50, "Catalog_Контрагенты_КонтактнаяИнформация"))
    assert stats["insert"] == 301
    flat = m.table(sec)
    assert flat.filter(F.col("Ссылка") == g(1)).count() == 300
    # the array form on demand, for the masters that ask for it
    masters = spark.createDataFrame([(g(2),)], "`Ссылка` string")
    nested = nest_lines(masters, flat, "Ссылка", "Ссылка", "КИ", ["Страна"], ["НомерСтроки"], only_masters=True).first()
    assert [(x["НомерСтроки"], x["Страна"]) for x in nested["КИ"]] == [(1, "X")]


def write_meta(scratch, text=METADATA):
    path = os.path.join(scratch, "meta.xml")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_incomplete_loads_change_nothing(spark, scratch):
    m = Mirror(spark, write_meta(scratch), root=scratch + "/mirror")
    docs = [doc(i) for i in range(10)]
    m.create_table(T, pages(spark, docs, 4))
    good = pages(spark, docs[:9], 4).collect()
    bodies = {r["page_no"]: r["body"] for r in good}
    cut = {**bodies, 1: bodies[1][:50]}
    error = {**bodies, 2: '{"odata.error": {"code": "-1"}}'}
    gap = {k: v for k, v in bodies.items() if k != 2}
    headless = {k: v for k, v in bodies.items() if k != 0}
    endless = {k: v for k, v in bodies.items() if k < 2}
    version = m.store.current_version(T)
    for bad, what in ((cut, "page 1: corrupt"), (error, "page 2: corrupt"), (gap, "page 2: gap"), (headless, "page 0: gap"), (endless, "page 1: no short page")):
        df = spark.createDataFrame([("Catalog_Контрагенты", k, k * 2, v) for k, v in bad.items()], pg.PAGE_SCHEMA)
        with pytest.raises(pg.IncompleteLoad, match=what):
            m.refresh(T, df)
        assert m.store.current_version(T) == version and m.table(T).count() == 10
    assert m.refresh(T, spark.createDataFrame(good))["delete"] == 1


@pytest.mark.parametrize("body", ['{"value":[{"Ref_Key":', '{"odata.error":{}}', '{"value":[{"Ref_Key":"%s","X":1e30}]}' % g(1)])
def test_unreadable_pages_stop_the_reader(spark, body):
    schema = "Ref_Key string, X decimal(38,10)"
    df = spark.createDataFrame([("T", 0, 0, body)], pg.PAGE_SCHEMA)
    with pytest.raises(Exception):
        pg.read_pages(df, spark.createDataFrame([], schema).schema).collect()


def test_metadata_changes_keep_rows_where_they_can(spark, scratch):
    meta = write_meta(scratch)
    m = Mirror(spark, meta, root=scratch + "/mirror")
    m.create_table(T, pages(spark, [doc(1), doc(2), doc(3)]))
    version = m.store.current_version(T)
    same = m.refresh_metadata(T)
    assert not (same["reload"] or same["add"] or same["drop"] or same["retype"])
    assert m.store.current_version(T) == version and m.table(T).count() == 3
    line = '    <Property Name="Description" Type="Edm.String"/>\n'
    assert line in METADATA
    write_meta(scratch, METADATA.replace(line, "", 1))
    dropped = m.refresh_metadata(T)
    assert not dropped["reload"] and dropped["drop"] == ["Наименование"] and m.table(T).count() == 3
    write_meta(scratch, METADATA.replace(line, "", 1).replace('<Property Name="Страна" Type="Edm.String"/>', '<Property Name="Страна" Type="Edm.Int64"/>'))
    retyped = m.refresh_metadata(T)
    assert retyped["reload"] and retyped["retype"] == ["КонтактнаяИнформация"] and m.table(T).count() == 0


def test_enumeration_is_filled_and_merged(spark, scratch):
    e = "Перечисление.ТипыНоменклатуры"
    m = Mirror(spark, write_meta(scratch), root=scratch + "/mirror")
    m.create_table(e)
    rows = lambda: {r[0]: r[1] for r in m.table(e).collect()}
    first = rows()
    assert set(first) == {"Товар", "Услуга"} and sorted(first.values()) == [1, 2]
    assert spark.sql(f"SELECT count(*) FROM `{e}`").first()[0] == 2
    write_meta(scratch, METADATA.replace('<Member Name="Товар"/>', '<Member Name="Набор"/>'))
    m.refresh_metadata(e)
    assert rows() == {"Услуга": first["Услуга"], "Набор": 3}


def test_missing_line_entity_is_an_error(spark, scratch):
    start = METADATA.index('<EntityType Name="Catalog_Контрагенты_КонтактнаяИнформация">')
    end = METADATA.index("</EntityType>", start) + len("</EntityType>")
    m = Mirror(spark, write_meta(scratch, METADATA[:start] + METADATA[end:]), root=scratch + "/mirror")
    with pytest.raises(LookupError, match="КонтактнаяИнформация"):
        m.describe(T)


def test_another_application_sees_the_mirror(spark, scratch):
    m = Mirror(spark, write_meta(scratch), root=scratch + "/mirror")
    m.create_table(T, pages(spark, [doc(1), doc(2)]))
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from mirrorsmith.session import build_session
from mirrorsmith.plans.mirror import MissingAnswers, Mirror
spark = build_session("local[1]", shuffle_partitions=2, extra={{"spark.mirrorsmith.root": {scratch + "/root"!r}}})
m = Mirror(spark, {scratch + "/meta.xml"!r}, root={scratch + "/mirror"!r})
assert m.table({T!r}).count() == 2 and m.control().first()["row_count"] == 2
assert Mirror(spark, {scratch + "/meta.xml"!r}).store.root == {scratch + "/root/DEFAULT"!r}
print("seen")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=scratch)
    assert "seen" in done.stdout, done.stderr[-2000:]


def test_old_versions_go_and_lost_updates_do_not_happen(spark, scratch):
    store = rf.MirrorStore(spark, scratch + "/store")
    for n in range(4):
        store.commit("T", spark.range(n + 1))
    with pytest.raises(rf.StaleBase):
        store.commit("T", spark.range(9), base=2)
    assert store.current_version("T") == 4
    assert store.prune("T", keep=2) == [1, 2]
    assert store.read("T").count() == 4 and store.commit("T", spark.range(7))[0] == 5


def test_one_full_page_of_a_smaller_fetch_size_is_refused(spark, scratch):
    meta = os.path.join(scratch, "meta.xml")
    with open(meta, "w", encoding="utf-8") as f:
        f.write(METADATA)
    all_pages = pages(spark, [doc(i) for i in range(7)], fetch=5)
    first = all_pages.filter("page_no = 0")
    m = Mirror(spark, meta, root=scratch + "/mirror")
    m.create_table(T, all_pages, fetch_size=5)
    with pytest.raises(pg.IncompleteLoad, match="no short page"):
        m.refresh(T, first)                                  # the recorded fetch size
    assert m.table(T).count() == 7
    pg.write_pages(first.withColumn("fetch_size", F.lit(5)), scratch + "/landed")
    landed = pg.read_landed(spark, scratch + "/landed")
    with pytest.raises(pg.IncompleteLoad, match="no short page"):
        pg.check_page_set(landed)                            # the landed one
    pg.check_page_set(landed, fetch_size=6)


def test_source_that_shrinks_grows_and_empties(spark, scratch):
    m = Mirror(spark, write_meta(scratch), root=scratch + "/mirror")
    m.create_table(T)
    m.refresh(T, pages(spark, [doc(i) for i in range(12)], 4), fetch_size=4)
    for k, n in enumerate((4, 40, 1, 0, 9)):
        folder = os.path.join(scratch, f"source{k}", "Catalog_Контрагенты")
        os.makedirs(folder)
        for page in range(120):     # behind its end the source answers with empty pages
            with open(os.path.join(folder, f"{page * 2}.json"), "w", encoding="utf-8") as f:
                json.dump({"value": [doc(i) for i in range(page * 2, min(n, page * 2 + 4))]}, f, ensure_ascii=False)
        stats = m.refresh(T, m.fetch_pages(T, "file://" + os.path.join(scratch, f"source{k}"), pages_per_partition=2))
        assert stats["row_count"] == n and {r["Ссылка"] for r in m.table(T).select("Ссылка").collect()} == {g(i) for i in range(n)}


def test_one_refused_table_does_not_stop_the_others(spark, scratch):
    m = Mirror(spark, write_meta(scratch), root=scratch + "/mirror")
    m.create_table(T, pages(spark, [doc(1)]))
    m.create_table("РегистрНакопления.Остатки")

    def pages_for(table):
        if table == T:
            return pages(spark, [doc(1), doc(2)])
        raise pg.IncompleteLoad("no pages")

    done = {d["table"]: d for d in m.refresh_all(pages_for)}
    assert done[T]["row_count"] == 2 and done["РегистрНакопления.Остатки"]["error"] == "IncompleteLoad: no pages"


def test_dropped_column_writes_no_file(spark, scratch):
    m = Mirror(spark, write_meta(scratch), root=scratch + "/mirror")
    m.create_table(T, pages(spark, [doc(i) for i in range(3)]))
    listing = lambda: sorted(os.path.join(d, n) for d, _, ns in os.walk(f"{m.store.root}/{T}/rows") for n in ns)
    had = listing()
    line = '    <Property Name="Description" Type="Edm.String"/>\n'
    write_meta(scratch, METADATA.replace(line, "", 1))
    assert m.refresh_metadata(T)["drop"] == ["Наименование"] and listing() == had and m.table(T).count() == 3
    write_meta(scratch, METADATA)
    back = m.refresh_metadata(T)                    # added again: its values are unknown until the source is read
    assert back["reload"] and m.table(T).count() == 0
    m.refresh(T, pages(spark, [doc(1)]))
    assert m.table(T).first()["Наименование"] == "c1"
