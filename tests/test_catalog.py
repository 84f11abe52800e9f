"""Catalog jobs on the metadata document of FIXTURES.md §1."""

import os

import pytest
from pyspark.sql import functions as F

from mirrorsmith.functions.names import abbreviation_candidates, assign_names
from mirrorsmith.plans import catalog as cat

METADATA = """<?xml version="1.0" encoding="UTF-8"?>
<edmx:Edmx xmlns:edmx="http://schemas.microsoft.com/ado/2007/06/edmx" Version="1.0"><edmx:DataServices><Schema Namespace="StandardODATA">
  <EntityType Name="Catalog_Контрагенты">
    <Key><PropertyRef Name="Ref_Key"/></Key>
    <Property Name="Ref_Key" Type="Edm.Guid"/>
    <Property Name="DataVersion" Type="Edm.String"/>
    <Property Name="DeletionMark" Type="Edm.Boolean"/>
    <Property Name="Description" Type="Edm.String"/>
    <Property Name="Менеджер" Type="Edm.String"/>
    <Property Name="Менеджер_Type" Type="Edm.String"/>
    <Property Name="Фото_Base64Data" Type="Edm.Binary"/>
    <Property Name="Фото" Type="Edm.Stream"/>
    <Property Name="КонтактнаяИнформация" Type="Collection(StandardODATA.Catalog_Контрагенты_КонтактнаяИнформация_RowType)"/>
  </EntityType>
  <EntityType Name="Catalog_Контрагенты_КонтактнаяИнформация">
    <Key><PropertyRef Name="Ref_Key"/><PropertyRef Name="LineNumber"/></Key>
    <Property Name="Ref_Key" Type="Edm.Guid"/>
    <Property Name="LineNumber" Type="Edm.Int64"/>
    <Property Name="Страна" Type="Edm.String"/>
  </EntityType>
  <EntityType Name="AccumulationRegister_Остатки_RecordType">
    <Key><PropertyRef Name="LineNumber"/></Key>
    <Property Name="LineNumber" Type="Edm.Int64"/>
    <Property Name="Period" Type="Edm.DateTime"/>
    <Property Name="Количество" Type="Edm.Double"/>
  </EntityType>
  <EnumType Name="ТипыНоменклатуры"><Member Name="Товар"/><Member Name="Услуга"/></EnumType>
  <EnumType Name="AccountType"><Member Name="Active"/></EnumType>
</Schema></edmx:DataServices></edmx:Edmx>
"""


@pytest.fixture(scope="module")
def metadata(spark, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("meta")), "metadata.xml")
    with open(path, "w", encoding="utf-8") as f:
        f.write(METADATA)
    ents, cplx, enums = cat.read_metadata_xml(spark, path)
    return cat.classify_objects(ents, cplx), cat.enum_types(enums)


def test_xml_scan_keeps_arrays_and_order(metadata):
    ents, _ = metadata
    row = ents.filter(F.col("name") == "Catalog_Контрагенты_КонтактнаяИнформация").first()
    assert row["keys"] == ["Ref_Key", "LineNumber"]
    assert [p["name"] for p in row["properties"]] == ["Ref_Key", "LineNumber", "Страна"]


def test_classification(metadata):
    ents, enums = metadata
    roots = {r["table"]: r["root"] for r in ents.collect()}
    assert roots["Справочник.Контрагенты"] is True
    assert roots["Справочник.Контрагенты_КонтактнаяИнформация"] is False
    assert [r["table"] for r in enums.collect()] == ["Перечисление.ТипыНоменклатуры"]


def test_list_objects(metadata):
    ents, enums = metadata
    got = sorted(r["table"] for r in cat.list_objects(ents, enums).collect())
    assert got == ["Перечисление.ТипыНоменклатуры", "РегистрНакопления.Остатки", "Справочник.Контрагенты"]


def test_describe_catalog(metadata):
    ents, _ = metadata
    d = cat.describe(ents, "Справочник.Контрагенты")
    assert [c.name for c in d.columns] == ["Ссылка", "ВерсияДанных", "ПометкаУдаления", "Наименование",
                                           "Менеджер", "Фото", "КонтактнаяИнформация"]
    assert d.column("Менеджер").engine == "value_any"
    assert d.column("Фото").engine == "bytea"
    assert d.key == ["Ссылка"] and d.sort == ["Ref_Key"] and d.version == "ВерсияДанных"
    sec = d.sections["КонтактнаяИнформация"]
    assert [c.name for c in sec.columns] == ["Ссылка", "НомерСтроки", "Страна"]


def test_describe_register_with_recorder(metadata):
    ents, _ = metadata
    d = cat.describe(ents, "РегистрНакопления.Остатки")
    assert [c.name for c in d.columns][:3] == ["Период", "Регистратор", "НомерСтроки"]
    # intent, not the letter: Recorder, Period and the metadata key
    assert d.key == ["Регистратор", "Период", "НомерСтроки"]
    assert d.entity == "AccumulationRegister_Остатки_RecordType"
    # registers page by the first scalar non-key columns
    assert d.sort == ["Количество"]


def test_enum_description_and_members(metadata, spark):
    _, enums = metadata
    d = cat.describe(enums, "Перечисление.ТипыНоменклатуры")
    assert [c.name for c in d.columns] == ["Ссылка", "Порядок"]
    m = [(r["ref"], r["pos"]) for r in cat.enum_members(enums, "Перечисление.ТипыНоменклатуры").collect()]
    assert m == [("Товар", 1), ("Услуга", 2)]


def test_abbreviation_chain(spark):
    df = spark.createDataFrame([("КонтактнаяИнформация",), ("Ab_cd",), ("lower",)], "n string")
    got = [r[0] for r in df.select(abbreviation_candidates(F.col("n"))).collect()]
    assert got[0] == ["КонтактнаяИнформация", "КонтактнаяИ", "КИ"]
    assert got[1] == ["Ab_cd", "Ab_c", "A_c"]
    assert got[2] == ["lower"]


def test_assign_names_sequential(spark):
    df = spark.createDataFrame([("e", 1, "ИмяФайла"), ("e", 2, "ИмяФайла"), ("e", 3, "ИмяФ"), ("f", 1, "Имя")],
                               "entity string, o int, n string")
    got = sorted((r["entity"], r["o"], r["name_out"]) for r in assign_names(df, ["entity"], "o", "n").collect())
    assert got == [("e", 1, "ИмяФайла"), ("e", 2, "ИмяФ"), ("e", 3, "ИФ"), ("f", 1, "Имя")]


def test_assign_names_short(spark):
    df = spark.createDataFrame([("e", 1, "КонтактнаяИнформация")], "entity string, o int, n string")
    got = assign_names(df, ["entity"], "o", "n", short=True, max_bytes=30).first()["name_out"]
    assert got == "КонтактнаяИ"                     # 40 bytes does not fit, 22 does


def test_line_types_count_for_their_own_server(spark):
    """An entity that is a section's line type on one server is an object of its own on another."""
    schema = "server string, name string, properties array<struct<name:string,type:string>>, keys array<string>"
    head = [{"name": "Ref_Key", "type": "Edm.Guid"}]
    lines = [{"name": "Товары", "type": "Collection(StandardODATA.Catalog_А_Товары_RowType)"}]
    ents = spark.createDataFrame([("S1", "Catalog_А", head + lines, ["Ref_Key"]), ("S1", "Catalog_А_Товары", head, ["Ref_Key"]),
                                  ("S2", "Catalog_А_Товары", head, ["Ref_Key"])], schema)
    got = {(r["server"], r["name"]): r["root"] for r in cat.classify_objects(ents, ents.limit(0)).collect()}
    assert got == {("S1", "Catalog_А"): True, ("S1", "Catalog_А_Товары"): False, ("S2", "Catalog_А_Товары"): True}


def test_view_names(spark):
    name = "РасчетыСКонтрагентамиПоДоговорам"             # 64 bytes
    assert cat.view_names(spark, name, ["Строки"]) == [name, name + "_Строки"]
    head, one, two = cat.view_names(spark, name, ["КонтактнаяИнформация", "КонтактнаяИстория"], short=True)
    assert head == "РасчетыСКонтрагентамиПоД"
    assert one != two and all(len(n.encode()) <= 63 for n in (one, two))
    assert cat.view_names(spark, "Имя", ["Аб", "аб"]) == ["Имя", "Имя_Аб", "Имя_а"]          # distinct without regard to case
    assert cat.view_names(spark, "ИмяФайла", [], used=["имяфайла"]) == ["ИмяФ"]
    with pytest.raises(ValueError):
        cat.view_names(spark, "lower", [], used=["lower"])


def test_short_names_of_views(spark, metadata, scratch):
    from mirrorsmith.plans.store import MirrorStore
    ents, _ = metadata
    d = cat.describe(ents, "Справочник.Контрагенты", short_names=True, used=["Контрагенты_КонтактнаяИ"])
    assert d.view == "Контрагенты" and len(d.sections["КонтактнаяИнформация"].view.encode()) <= 63
    store = MirrorStore(spark, scratch)
    store.commit(d.table, spark.createDataFrame([], d.spark_schema()))
    store.register(d.table, d)
    view = "`Справочник." + d.sections["КонтактнаяИнформация"].view + "`"
    assert spark.sql(f"SELECT * FROM {view}").columns == ["Ссылка", "НомерСтроки", "Страна"]
