"""Sections, quality checks and schema evolution."""

from pyspark.sql import functions as F

from mirrorsmith.operators import quality as qa
from mirrorsmith.operators import sections as sc
from mirrorsmith.plans import evolve as ev
from mirrorsmith.plans.description import ColumnDesc, TableDescription


def test_nest_then_explode_is_identity(spark):
    master = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, name string")
    lines = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "fk int, n int, v string")
    nested = sc.nest_lines(master, lines, "id", "fk", "lines", ["v"], ["n"])
    got = {r["id"]: [(l["id"], l["n"], l["v"]) for l in r["lines"]] for r in nested.collect()}
    assert got == {1: [(1, 1, "a"), (1, 2, "b")], 2: [(2, 1, "c")], 3: []}
    back = sorted(tuple(r) for r in sc.explode_section(nested, "lines").collect())
    assert back == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]      # master 3 has no lines and vanishes


def test_field_array_and_contains(spark):
    df = spark.createDataFrame([(1, [("RU",), ("DE",)]), (2, [("DE",)]), (3, [])],
                               "id int, s array<struct<c:string>>")
    arr = sc.field_array(F.col("s"), "c")
    got = {r["id"]: (r["a"], r["one"], r["both"]) for r in df.select(
        "id", arr.alias("a"), sc.contains_all(arr, ["RU"]).alias("one"),
        sc.contains_all(arr, ["RU", "DE"]).alias("both")).collect()}
    assert got == {1: (["RU", "DE"], True, True), 2: (["DE"], False, False), 3: ([], False, False)}


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [("00000000-0000-0000-0000-000000000000", None, ("v", "Edm.String")),
         ("a0000000-0000-0000-0000-000000000001", "x", ("v", "Справочник.X"))],
        "g string, t string, c struct<value:string,type:string>")
    desc = TableDescription("T.X", "Catalog", "Catalog_X",
                            [ColumnDesc("K", "Edm.Guid", "k", "uuid"), ColumnDesc("G", "Edm.Guid", "g", "uuid"),
                             ColumnDesc("T", "Edm.String", "t", "text"), ColumnDesc("C", "Edm.String", "c", "value_any")],
                            key=["k"])
    checks = [c for c in qa.description_checks(desc) if c[0] != "k"]
    got = {(r["column_name"], r["check_name"]): r["n_violations"] for r in qa.check_columns(df, checks).collect()}
    assert got == {("g", "zero_guid"): 1, ("t", "not_null"): 1, ("c", "primitive_type"): 1}


def test_pk_fk(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10)], "id int, ref int")
    parent = spark.createDataFrame([(10,), (12,)], "pk int")
    assert [r["id"] for r in qa.fk_violations(child, ["ref"], parent, ["pk"]).collect()] == [2]
    assert [(r["ref"], r["n_rows"]) for r in qa.pk_violations(child.filter("ref is not null"), ["ref"]).collect()] == [(10, 2)]


def test_schema_diff_and_apply(spark):
    desc = TableDescription("T.X", "Catalog", "Catalog_X",
                            [ColumnDesc("K", "Edm.Int64", "k", "int8"), ColumnDesc("A", "Edm.String", "a", "text"),
                             ColumnDesc("B", "Edm.Boolean", "b", "bool")], key=["k"])
    cur = spark.createDataFrame([(1, "x", 5)], "k long, a string, old int")
    plan = ev.plan_changes(spark, desc, cur.schema)
    assert plan["add"] == ["b"] and plan["drop"] == ["old"] and sorted(plan["same"]) == ["a", "k"]
    projected, reload = ev.apply_schema(cur, desc)
    assert reload and projected.count() == 0 and projected.columns == ["k", "a", "b"]
    ok, reload2 = ev.apply_schema(spark.createDataFrame([(1, "x", True, 5)], "k long, a string, b boolean, old int"), desc)
    assert not reload2 and ok.columns == ["k", "a", "b"]


def test_scale_conf():
    from mirrorsmith.session import scale_conf
    conf = scale_conf(100 * (1 << 40), 8000)                 # 100 TB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10 << 20, 8)["spark.sql.shuffle.partitions"]) == 16
