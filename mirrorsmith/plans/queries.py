"""The registered queries: every operator of the mirror on the given tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Output columns carry plain ASCII names so that the SQL oracle in
`mirrorsmith.plans.oracle` can name them identically.  Numbers that pass
through the exact decimal type are cast to DOUBLE only at the end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mirrorsmith.fixtures import source as fx
from mirrorsmith.functions import names as nm
from mirrorsmith.functions import types as ty
from mirrorsmith.functions.constants import KINDS, ZERO_DATETIME, ZERO_GUID
from mirrorsmith.functions.decode import decode_json, type_list, type_ref, value_any
from mirrorsmith.functions.literals import key_filter as join_terms, key_term, mask_credentials
from mirrorsmith.operators import chunks as ck
from mirrorsmith.operators import incremental as inc
from mirrorsmith.operators import merge as mg
from mirrorsmith.operators import quality as qa
from mirrorsmith.operators import sections as sc
from mirrorsmith.operators.dedup import first_arrival
from mirrorsmith.operators.ordinal import with_ordinal
from mirrorsmith.plans.description import ColumnDesc, TableDescription
from mirrorsmith.plans.refresh import (commit_answers, commit_changes, containing, default_fetch_size, ensure_snapshot, landed, load_from_pages, lookup,
                                       maintain_view, materialize, refresh_and_commit, select_refresh, snapshot_root)
from mirrorsmith.plans.store import MirrorStore
from mirrorsmith.session import checkpoint_dir
from mirrorsmith.sources import pages as pg
from mirrorsmith.sources import tables as tb

TS_TEXT = "yyyy-MM-dd HH:mm:ss"
DEDUP_FETCH_SIZE = 100          # page size of the dedup scenario
DOCUMENT_FETCH_SIZE = 1000      # page size of the order document refresh
TOPK = 10
VIEW_LIMIT = 20
EXCLUDED_TYPE = "PROMO"         # the "service" item type left out of sales


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tb.table(spark, sf_dir, name)


def _dbl(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def _ts_text(c: Column) -> Column:
    return F.date_format(c, TS_TEXT)


# ==========================================================================
# Decoding (OP-11..16)
# ==========================================================================

PROPS_DESC = TableDescription(
    table="Справочник.Свойства", kind="Catalog", entity="Catalog_Свойства",
    columns=[ColumnDesc("k", "Edm.Int64", "k", "int8"),
             ColumnDesc("z", "Edm.Double", "z_num", "numeric"),
             ColumnDesc("zb", "Edm.Boolean", "z_bool", "bool"),
             ColumnDesc("zt", "Edm.String", "z_text", "text")],
    key=[])


def json_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-11: ``events.props`` decoded by a description; absent fields take
    their type's empty value."""
    ev = _t(spark, sf_dir, "events")
    out = decode_json(ev, "props", PROPS_DESC, keep=["event_id"])
    return out.select("event_id", "k", F.col("z_num").cast("double").alias("z_num"), "z_bool", "z_text")


EVENT_DESC = TableDescription(
    table="РегистрСведений.События", kind="InformationRegister", entity="InformationRegister_События",
    columns=[ColumnDesc("Ref_Key", "Edm.Guid", "Ссылка", "uuid"),
             ColumnDesc("User_Key", "Edm.Guid", "Пользователь", "uuid"),
             ColumnDesc("Period", "Edm.DateTime", "Период", "timestamp"),
             ColumnDesc("Value", "Edm.Double", "Значение", "numeric"),
             ColumnDesc("Success", "Edm.Boolean", "Успех", "bool"),
             ColumnDesc("Kind", "Edm.String", "Вид", "text"),
             ColumnDesc("Data_Base64Data", "Edm.Binary", "Данные", "bytea")],
    key=["Ссылка"])


def json_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-12: every empty-value rule on one decoded register."""
    dec = decode_json(fx.event_json(_t(spark, sf_dir, "events")), "json", EVENT_DESC)
    return dec.select(
        tb.key_of_guid(F.col("Ссылка")).alias("event_id"),
        F.col("Пользователь").alias("user_guid"),
        _ts_text(F.col("Период")).alias("period"),
        F.col("Значение").cast("double").alias("value"),
        F.col("Успех").alias("success"),
        F.col("Вид").alias("kind"),
        F.col("Данные").cast("string").alias("data"))


ZERO_DESC_COLS = [ColumnDesc("Period", "Edm.DateTime", "Период", "timestamp"),
                  ColumnDesc("Date", "Edm.DateTime", "Дата", "timestamp"),
                  ColumnDesc("Customer_Key", "Edm.Guid", "Покупатель", "uuid"),
                  ColumnDesc("Lines", "Collection(StandardODATA.X_RowType)", "Строки", ty.SECTION)]


def _zero_desc() -> TableDescription:
    from mirrorsmith.plans.description import SectionDesc
    sec = SectionDesc("Lines", "X_Строки",
                      [ColumnDesc("Period", "Edm.DateTime", "Период", "timestamp"),
                       ColumnDesc("Date", "Edm.DateTime", "Дата", "timestamp"),
                       ColumnDesc("Customer_Key", "Edm.Guid", "Покупатель", "uuid")])
    return TableDescription(table="РегистрСведений.X", kind="InformationRegister", entity="InformationRegister_X",
                            columns=ZERO_DESC_COLS, key=["Период"], sections={"Строки": sec})


def zero_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-12: zero date / zero GUID become NULL in non-key master columns and
    stay values in keys and in section lines."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    date = F.when(k % 7 == 0, F.lit(ZERO_DATETIME)).otherwise(F.date_format("o_orderdate", tb.ISO_SECONDS))
    cust = F.when(k % 7 == 0, F.lit(ZERO_GUID)).otherwise(tb.guid_of(F.col("o_custkey")))
    row = F.struct(date.alias("Period"), date.alias("Date"), cust.alias("Customer_Key"),
                   F.array(F.struct(date.alias("Date"), cust.alias("Customer_Key"))).alias("Lines"))
    dec = decode_json(o.select("o_orderkey", F.to_json(row).alias("json")), "json", _zero_desc(), keep=["o_orderkey"])
    line = F.element_at("Строки", 1)
    return dec.select(
        "o_orderkey",
        _ts_text(F.col("Период")).alias("key_date"),
        _ts_text(F.col("Дата")).alias("order_date"),
        F.col("Покупатель").alias("customer_guid"),
        _ts_text(line.getField("Дата")).alias("line_date"),
        line.getField("Покупатель").alias("line_customer_guid"))


def _kind_by(n: Column) -> Column:
    """Source kind name number ``n`` (0..14) of the fixed kind list."""
    return F.element_at(F.array(*[F.lit(k) for k, _ in KINDS]), (n % len(KINDS) + 1).cast("int"))


def _event_source_type(ev: DataFrame) -> Column:
    t, u = F.col("event_type"), F.col("user_id")
    return (F.when(t == "click", F.concat(F.lit("StandardODATA."), _kind_by(u), F.lit("_Obj"), (u % 7).cast("string")))
            .when(t == "signup", F.concat(F.lit("StandardODATA.Пол"), (u % 3).cast("string")))
            .when(t == "view", F.when(u % 2 == 0, F.lit("StandardODATA.Undefined")).otherwise(F.lit("")))
            .when(t == "purchase", F.when(u % 2 == 0, F.lit("Edm.Int64")).otherwise(F.lit("Edm.Guid")))
            .otherwise(F.lit(None).cast("string")))


def value_any_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-13: composite values from (value, type) pairs."""
    ev = _t(spark, sf_dir, "events")
    v = value_any(F.col("user_id").cast("string"), _event_source_type(ev))
    return ev.select("event_id", v.getField("value").alias("any_value"), v.getField("type").alias("any_type"))


def _event_type_ref(ev: DataFrame) -> Column:
    t, u = F.col("event_type"), F.col("user_id")
    return (F.when(t.isin("click", "view"), F.concat(_kind_by(u), F.lit("Ref.Obj"), (u % 5).cast("string")))
            .when(t == "signup", F.concat(F.lit("EnumRef.Пол"), (u % 3).cast("string")))
            .otherwise(F.concat(F.lit("Edm."), t)))


def type_ref_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-14 / OP-15: type references and type-description arrays."""
    ev = _t(spark, sf_dir, "events")
    ref = _event_type_ref(ev)
    types = F.when(F.col("event_type") == "error", F.lit(None).cast("array<string>")) \
        .otherwise(F.array(ref, F.lit("EnumRef.Пол"), F.lit("string")))
    return ev.select("event_id", ref.alias("ref_src"), type_ref(ref).alias("ref_local"),
                     F.array_join(type_list(types), "|").alias("type_list"))


def _event_type_src(ev: DataFrame) -> Column:
    t, u = F.col("event_type"), F.col("user_id")
    return (F.when(t == "click", F.lit("Edm.Guid"))
            .when(t == "view", F.when(u % 2 == 0, F.lit("Edm.Int64")).otherwise(F.lit("Edm.Int16")))
            .when(t == "purchase", F.when(u % 2 == 0, F.lit("Edm.Double")).otherwise(F.lit("Edm.Boolean")))
            .when(t == "signup", F.when(u % 2 == 0, F.lit("Edm.DateTime")).otherwise(F.lit("StandardODATA.TypeDescription")))
            .otherwise(F.when(u % 2 == 0, F.lit("Collection(StandardODATA.Catalog_X_Y_RowType)"))
                       .otherwise(F.lit("Edm.String"))))


def map_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-16: source type → engine type, composite fields first."""
    ev = _t(spark, sf_dir, "events")
    composite = F.col("user_id") % 3 == 0
    src = _event_type_src(ev)
    return ev.select("event_id", src.alias("type_src"), composite.alias("composite"),
                     ty.engine_type_col(src, composite).alias("engine_type"))


SHORT_NAME_BYTES = 12


def abbreviate_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-17: abbreviation chain of capitalised part names + a Cyrillic word,
    and the first candidate that fits ``SHORT_NAME_BYTES`` bytes."""
    p = _t(spark, sf_dir, "part")
    name = F.concat(nm.capitalised(F.col("p_name")), F.lit("Информация"))
    c = nm.abbreviation_candidates(name)
    return p.select("p_partkey", name.alias("name"),
                    F.element_at(c, -1).alias("shortest"),
                    F.size(c).cast("long").alias("n_candidates"),
                    nm.first_fitting(c, SHORT_NAME_BYTES).alias("short_name"),
                    F.octet_length(name).cast("long").alias("name_bytes"))


def key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-18: typed ``$filter`` text of a composite key per order."""
    o = _t(spark, sf_dir, "orders")
    terms = [key_term("Ref_Key", "uuid", tb.guid_of(F.col("o_orderkey"))),
             key_term("Date", "timestamp", F.col("o_orderdate")),
             key_term("Priority", "text", F.concat(F.col("o_orderpriority"), F.lit("'s"))),
             key_term("Customer", "int8", F.col("o_custkey"))]
    return o.select("o_orderkey", join_terms(terms).alias("filter"))


def _with_credentials(url: Column, page_id: Column) -> Column:
    return F.regexp_replace(url, "^([a-z]+://)", F.concat(F.lit("$1user"), page_id.cast("string"),
                                                         F.lit(":secret"), page_id.cast("string"), F.lit("@")))


def mask_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-09: request URLs with credentials, password masked for the log."""
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", mask_credentials(_with_credentials(F.col("url"), F.col("page_id"))).alias("logged_url"))


# ==========================================================================
# Pages and dedup (OP-01..03)
# ==========================================================================

def control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One control row per given table: its row count at the source, kind,
    default page size.  ``region`` plays an enumeration."""
    rows = None
    for name in tb.TABLE_NAMES:
        one = _t(spark, sf_dir, name).agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
            .select(F.lit(name).alias("table"), "row_count")
        rows = one if rows is None else rows.unionByName(one)
    return rows.select(
        F.lit("DEFAULT").alias("server"), "table",
        F.when(F.col("table") == "region", F.lit("Enumeration")).otherwise(F.lit("Catalog")).alias("kind"),
        F.lit(default_fetch_size()).alias("fetch_size"), "row_count")


def plan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-02: requests of a full refresh for every table and page size."""
    ctl = control_table(spark, sf_dir).select(
        "table", "row_count", F.explode(F.array(F.lit(100), F.lit(1000))).alias("fetch_size"))
    ctl = ctl.withColumn("entity", F.concat(F.lit("Catalog_"), F.col("table"))).withColumn("sort", F.lit("Ref_Key"))
    req = pg.plan_requests(ctl)
    per = req.groupBy("table", "entity", "sort", "fetch_size", "row_count").agg(
        F.count(F.lit(1)).cast("long").alias("n_pages"),
        F.sum("rows").cast("long").alias("rows_transferred"),
        F.max("skip").cast("long").alias("last_skip"))
    last_url = pg.request_url(F.col("entity"), F.col("sort"), F.col("last_skip"), F.col("fetch_size"))
    return per.select(
        F.col("table").alias("table_name"), F.col("fetch_size").cast("long").alias("fetch_size"),
        "row_count", "n_pages", "rows_transferred", "last_skip", last_url.alias("last_url"))


def dedup_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-01 + OP-03: events paged with half-page overlap, later copies
    altered; reading and deduplicating keeps each first arrival."""
    def build() -> DataFrame:
        ev = _t(spark, sf_dir, "events")
        numbered = with_ordinal(ev, ["event_id"], "n", total_name="n_total")
        js = fx.event_json(numbered, keep=["n", "n_total"])
        return fx.land_pages(js, "json", "n", DEDUP_FETCH_SIZE, "events", later_copy=fx.altered, total_col="n_total")

    # the responses land once per input; the query reads and deduplicates them
    pages = landed(spark, "InformationRegister_События@paged", [f"{sf_dir}/events.parquet"], build)
    from mirrorsmith.functions.decode import decode_row, read_schema
    rows = pg.read_pages(pages, read_schema(EVENT_DESC))
    dec = rows.select("page_no", "pos", *decode_row(F.col("row"), EVENT_DESC))
    first = first_arrival(dec, ["Ссылка"])
    return first.select(tb.key_of_guid(F.col("Ссылка")).alias("event_id"),
                        F.col("page_no").cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"),
                        F.col("Значение").cast("double").alias("value"), F.col("Вид").alias("kind"))


def page_set_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-01/06: the state of each landed page of the order documents, where
    some answers were cut off and some are missing; a refresh from such pages
    is refused (`pages.check_page_set`)."""
    landed_now = landed_pages(spark, sf_dir, "src").filter(F.col("page_no") % 11 != 5)
    cut_off = F.when(F.col("page_no") % 7 == 3, F.substr("body", F.lit(1), F.length("body") - 20)).otherwise(F.col("body"))
    return pg.page_states(landed_now.withColumn("body", cut_off), DOCUMENT_FETCH_SIZE)


# ==========================================================================
# Sections (OP-22..26)
# ==========================================================================

def source_pages(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    """The source's responses for the order documents of one state: JSON
    objects in key order, paged with half-page overlap."""
    o = _t(spark, sf_dir, "orders")
    li = _t(spark, sf_dir, "lineitem")
    # positions are taken on the narrow header rows, before the documents
    # (with their lines) are built, so no sort moves whole documents
    numbered = with_ordinal(tb.order_state(o, state), ["o_orderkey"], "n", total_name="n_total")
    rows = fx.document_rows(numbered, fx.order_lines(li))
    return fx.land_pages(rows, fx.document_body(), "n", DOCUMENT_FETCH_SIZE, tb.DOCUMENT_ENTITY, total_col="n_total")


def stored_mirror(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    """The order document mirror as stored by its last refresh.

    Queries read the stored snapshot, as users of the mirror do; the JSON is
    decoded by the refresh that writes it.  When no snapshot of this state of
    the given tables exists yet, one full refresh from the source pages
    writes it (see `mirrorsmith.plans.refresh.ensure_snapshot`).
    """
    desc = tb.document_description(spark)
    return ensure_snapshot(spark, f"{tb.DOCUMENT_TABLE}@{state}", desc, _document_inputs(sf_dir),
                           lambda: landed_pages(spark, sf_dir, state))


def _document_inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/orders.parquet", f"{sf_dir}/lineitem.parquet"]


def landed_pages(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    """The source's responses for one state as they landed in the shared
    folder (landed on first use from the given tables)."""
    return landed(spark, f"{tb.DOCUMENT_ENTITY}@{state}", _document_inputs(sf_dir),
                  lambda: source_pages(spark, sf_dir, state))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents (header + lines section) of the mirror of all orders."""
    return stored_mirror(spark, sf_dir, "all")


def build_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-22: section arrays per order, summarised row-locally."""
    d = order_documents(spark, sf_dir)
    s = F.col("Товары")
    return d.select(
        tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"),
        sc.line_count(s).cast("long").alias("n_lines"),
        _dbl(sc.line_sum(s, "Количество", "decimal(38,10)")).alias("sum_qty"),
        _dbl(sc.line_sum(s, "Сумма", "decimal(38,10)")).alias("sum_price"),
        F.coalesce(F.array_max(s.getField("НомерСтроки")), F.lit(0)).cast("long").alias("last_line_no"),
        F.forall(s, lambda x: x.getField("Ссылка") == F.col("Ссылка")).alias("master_key_ok"))


def explode_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-23: the detail view; orders without lines disappear."""
    d = order_documents(spark, sf_dir)
    lines = sc.explode_section(d, "Товары")
    return lines.select(
        tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"),
        F.col("НомерСтроки").alias("line_no"),
        tb.key_of_guid(F.col("Номенклатура")).alias("l_partkey"),
        F.col("Количество").cast("double").alias("quantity"),
        F.col("Сумма").cast("double").alias("amount"),
        F.col("ПризнакВозврата").alias("return_flag"),
        _ts_text(F.col("ДатаОтгрузки")).alias("ship_date"))


def section_field_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-24 / OP-25: a section field as an array (flattened to text)."""
    d = order_documents(spark, sf_dir)
    parts = F.transform(sc.field_array(F.col("Товары"), "Номенклатура"), lambda g: tb.key_of_guid(g).cast("string"))
    return d.select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"),
                    F.array_join(parts, ",").alias("part_keys"),
                    F.size(parts).cast("long").alias("n_parts"))


def section_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-26: orders whose lines contain both return flags A and R."""
    d = order_documents(spark, sf_dir)
    flags = sc.field_array(F.col("Товары"), "ПризнакВозврата")
    return (d.filter(sc.contains_all(flags, ["A", "R"]))
            .select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"),
                    sc.line_count(F.col("Товары")).cast("long").alias("n_lines")))


def section_contains_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-26 through a value index that a refresh has kept up: the mirror is
    indexed, refreshed to the source's state, and searched for the documents
    that hold the part of the dearest line."""
    store, desc = _branch(spark, sf_dir)
    store.create_index(desc.table, "Товары", "Номенклатура")
    refresh_and_commit(store, desc, landed_pages(spark, sf_dir, "src"), fetch_size=DOCUMENT_FETCH_SIZE)
    one = _t(spark, sf_dir, "lineitem").agg(F.max_by("l_partkey", F.struct("l_extendedprice", "l_partkey")).alias("p")).select(tb.guid_of(F.col("p"))).first()[0]
    hits = containing(store, desc.table, "Товары", "Номенклатура", [one])
    return hits.select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"), sc.line_count(F.col("Товары")).cast("long").alias("n_lines"))


# Lines per chunk of the scenario: the given orders have few lines each.
CHUNK_LINES = 2
CHUNK_COLS = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]


def _chunked_lines(lines: DataFrame) -> DataFrame:
    return ck.chunk_lines(lines, "l_orderkey", "lines", CHUNK_COLS, tb.LINE_ORDER, CHUNK_LINES)


def _chunk_rows(chunked: DataFrame) -> DataFrame:
    s = F.col("lines")
    return chunked.select(F.col("l_orderkey").alias("o_orderkey"), F.col(ck.CHUNK), F.size(s).cast("long").alias("n_lines"),
                          F.array_join(F.transform(s.getField("l_partkey"), lambda p: p.cast("string")), ",").alias("part_keys"),
                          sc.line_sum(s, "l_quantity", "decimal(38,10)").cast("double").alias("sum_qty"))


def section_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-22 in chunks of bounded size, from flat lines."""
    return _chunk_rows(_chunked_lines(_t(spark, sf_dir, "lineitem")))


def section_chunks_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-23 over chunks, split from the stored documents without a shuffle."""
    d = order_documents(spark, sf_dir)
    lines = sc.explode_section(ck.split_section(d, "Ссылка", "Товары", CHUNK_LINES), "Товары", keep=[ck.CHUNK])
    return lines.select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"), ck.CHUNK, F.col("НомерСтроки").alias("line_no"),
                        tb.key_of_guid(F.col("Номенклатура")).alias("l_partkey"), F.col("Количество").cast("double").alias("quantity"))


def section_chunks_contain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-26 over chunks: orders whose lines hold both return flags A and R,
    with the totals of their lines."""
    chunked = _chunked_lines(_t(spark, sf_dir, "lineitem"))
    found = ck.holding_all(chunked, "l_orderkey", "lines", "l_returnflag", ["A", "R"])
    sums = ck.totals(chunked, "l_orderkey", "lines", {"qty": ("l_quantity", "decimal(38,10)")})
    return found.join(sums, "l_orderkey").select(F.col("l_orderkey").alias("o_orderkey"), "n_lines", _dbl(F.col("qty")).alias("sum_qty"))


def section_chunks_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-22 / OP-30: the chunks of `cur` as a stored table, refreshed to those
    of `src` by value with the key (order, chunk)."""
    def chunked(state: str) -> DataFrame:
        o, li = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")
        chunks = _chunked_lines(fx.line_rows(li, tb.order_state(o, state), changed=state == "src").drop("line_no"))
        # a bucket in one task, as the store writes them
        return chunks.repartition(*key)

    key, name = ["l_orderkey", ck.CHUNK], "sections/order_lines"
    store = MirrorStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/branches/{uuid.uuid4().hex}")
    store.commit(name, chunked("cur"), bucket_key=key)
    commit_changes(store, name, chunked("src"), key)
    return _chunk_rows(store.read(name))


# ==========================================================================
# Merge (OP-29..35)
# ==========================================================================

KEY = ["o_orderkey"]


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, sf_dir, "orders")
    return tb.order_state(o, "cur"), tb.order_state(o, "src")


def merge_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-30: the mirror after a complete load, with each key's action."""
    cur, src = _states(spark, sf_dir)
    m = mg.merge_full(cur, src, KEY, version="ver", with_action=True)
    return m.select("o_orderkey", "ver", "o_orderstatus", "o_totalprice", "action")


def merge_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur, src = _states(spark, sf_dir)
    return mg.change_counts(mg.change_set(cur, src, KEY, version="ver")).select(
        "action", F.col("n_rows").cast("long").alias("n_rows"))


def merge_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur, src = _states(spark, sf_dir)
    return mg.inserts(cur, src, KEY).select("o_orderkey", "ver", "o_totalprice")


def merge_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur, src = _states(spark, sf_dir)
    return mg.deletes(cur, src, KEY).select("o_orderkey", "ver")


def _changed(spark: SparkSession, sf_dir: str, by_version: bool) -> DataFrame:
    cur, src = _states(spark, sf_dir)
    ch = mg.change_set(cur, src, KEY, version="ver" if by_version else None)
    return ch.filter(F.col("action") == mg.UPDATE).select(
        "o_orderkey",
        mg.old("o_orderstatus").alias("old_status"), mg.new("o_orderstatus").alias("new_status"),
        mg.old("o_totalprice").alias("old_price"), mg.new("o_totalprice").alias("new_price"))


def diff_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-31: changed rows are those whose version differs."""
    return _changed(spark, sf_dir, True)


def diff_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-31: without a version, any NULL-safe difference of a column."""
    return _changed(spark, sf_dir, False)


def _refreshed_by_lines(spark: SparkSession, sf_dir: str, flag: str | None) -> DataFrame:
    cur, src = _states(spark, sf_dir)
    li = _t(spark, sf_dir, "lineitem")
    if flag is not None:
        li = li.filter(F.col("l_returnflag") == flag)
    keys = li.select(F.col("l_orderkey").alias("o_orderkey"))
    return mg.refresh_by_key(cur, src, keys, KEY)


def refresh_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-34: refresh the orders referenced by returned lines, as one batch."""
    m = _refreshed_by_lines(spark, sf_dir, "R")
    return m.select("o_orderkey", "ver", "o_orderstatus", "o_totalprice")


def refresh_by_key_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-34 on the stored document mirror: the orders referenced by returned
    lines are requested from the source; each answer is a JSON response
    ``{"keys": ..., "value": [document]}`` (empty ``value``: the order is gone)
    and the batch is applied by the keyed-refresh step of the stream."""
    from mirrorsmith.streaming.keyed_refresh import apply_responses

    def build() -> DataFrame:
        o = _t(spark, sf_dir, "orders")
        li = _t(spark, sf_dir, "lineitem")
        keys = li.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        src = fx.document_json(tb.order_state(o, "src"), fx.order_lines(li))
        answers = keys.join(src, "o_orderkey", "left")
        body = F.concat(F.lit('{"keys":{"Ref_Key":"'), tb.guid_of(F.col("o_orderkey")), F.lit('"},"value":['),
                        F.coalesce(F.col("json"), F.lit("")), F.lit("]}"))
        return answers.select(F.lit(tb.DOCUMENT_ENTITY).alias("table"), F.lit(0).alias("page_no"),
                              F.lit(None).cast("long").alias("skip"), body.alias("body"))

    # the answers land once per input (as the stream would find them); the query applies them
    responses = landed(spark, f"{tb.DOCUMENT_ENTITY}@keys", _document_inputs(sf_dir), build) \
        .select(F.col("body").alias("value"))
    mirror = apply_responses(responses, tb.document_description(spark), stored_mirror(spark, sf_dir, "cur"))
    return mirror.select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"), F.col("ВерсияДанных").alias("ver"),
                         F.col("Статус").alias("o_orderstatus"),
                         F.col("СуммаДокумента").cast("double").alias("o_totalprice"))


def _branch(spark: SparkSession, sf_dir: str, state: str = "cur", desc: TableDescription | None = None, pages=None) -> tuple[MirrorStore, TableDescription]:
    """A mirror of its own over the stored one's files, for a query that refreshes it."""
    desc = desc or tb.document_description(spark)
    name = f"{desc.table}@{state}"
    ensure_snapshot(spark, name, desc, _document_inputs(sf_dir), pages or (lambda: landed_pages(spark, sf_dir, state)))
    source = MirrorStore(spark, snapshot_root(spark, _document_inputs(sf_dir)))
    store = MirrorStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/branches/{uuid.uuid4().hex}")
    source.clone(name, store, desc.table)
    return store, desc


def key_answers_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-34 across batches: each order of a returned line is answered twice, as
    it was (first) and as the source has it now (second; some are gone).  The
    answers land in two batches in mixed order, one of them comes again: the
    later answer of each key counts, whichever batch brought it."""
    from mirrorsmith.streaming.keyed_refresh import apply_batch

    def build() -> DataFrame:
        o = _t(spark, sf_dir, "orders")
        li = _t(spark, sf_dir, "lineitem")
        keys = li.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        lines = fx.order_lines(li)
        told = [keys.join(fx.document_json(tb.order_state(o, state), lines), "o_orderkey", "left").withColumn("seq", F.lit(seq))
                for seq, state in ((1, "all"), (2, "src"))]
        answers = told[0].unionByName(told[1])
        body = F.concat(F.lit('{"keys":{"Ref_Key":"'), tb.guid_of(F.col("o_orderkey")), F.lit('"},"seq":'), F.col("seq"), F.lit(',"value":['),
                        F.coalesce(F.col("json"), F.lit("")), F.lit("]}"))
        # of every second key the later answer comes first
        return answers.select(F.lit(tb.DOCUMENT_ENTITY).alias("table"), ((F.col("o_orderkey") + F.col("seq")) % 2).cast("int").alias("page_no"),
                              F.lit(None).cast("long").alias("skip"), body.alias("body"))

    answers = landed(spark, f"{tb.DOCUMENT_ENTITY}@batches", _document_inputs(sf_dir), build)
    store, desc = _branch(spark, sf_dir)
    for number, batch in enumerate((0, 1)):
        apply_batch(store, desc, answers.filter(F.col("page_no") == batch).select(F.col("body").alias("value")), stream="answers", number=number)
    apply_batch(store, desc, answers.filter(F.col("page_no") == 0).select(F.col("body").alias("value")), stream="answers", number=0)
    return store.read(desc.table).select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"), F.col("ВерсияДанных").alias("ver"),
                                         F.col("Статус").alias("o_orderstatus"), F.col("СуммаДокумента").cast("double").alias("o_totalprice"))


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-29 on the document mirror: the orders that lines refer to are asked
    for and refreshed by key, then every line meets its order; a key the source
    no longer has gives NULLs (left outer)."""
    from mirrorsmith.streaming.keyed_refresh import answers_of

    def build() -> DataFrame:
        li = _t(spark, sf_dir, "lineitem")
        src = fx.document_json(tb.order_state(_t(spark, sf_dir, "orders"), "src"), fx.order_lines(li))
        asked = li.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        body = F.concat(F.lit('{"keys":{"Ref_Key":"'), tb.guid_of(F.col("o_orderkey")), F.lit('"},"value":['),
                        F.coalesce(F.col("json"), F.lit("")), F.lit("]}"))
        return asked.join(src, "o_orderkey", "left").select(F.lit(tb.DOCUMENT_ENTITY).alias("table"), F.lit(0).alias("page_no"),
                                                            F.lit(None).cast("long").alias("skip"), body.alias("body"))

    answers = landed(spark, f"{tb.DOCUMENT_ENTITY}@lookup", _document_inputs(sf_dir), build)
    store, desc = _branch(spark, sf_dir)
    commit_answers(store, desc.table, answers_of(answers.select(F.col("body").alias("value")), desc), desc.key)
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    found = lookup(store, desc.table, li.select(tb.guid_of(F.col("l_orderkey")).alias("Ссылка")).distinct(), desc.key)
    return li.join(found.select(tb.key_of_guid(F.col("Ссылка")).alias("l_orderkey"), F.col("ВерсияДанных").alias("ver"),
                                F.col("СуммаДокумента").cast("double").alias("o_totalprice")), "l_orderkey", "left")


def _priority_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the priority enumeration as the metadata lists them:
    every priority used by an order, in name order."""
    o = _t(spark, sf_dir, "orders")
    distinct = o.select(F.col("o_orderpriority").alias("ref")).distinct()
    return with_ordinal(distinct, ["ref"], "pos").select("ref", (F.col("pos") + 1).alias("pos"))


def _priority_existing(members: DataFrame) -> DataFrame:
    """The enumeration mirror before the refresh: all members but the first,
    numbered 10, 20, ..., plus one member the source has since removed."""
    kept = members.filter(F.col("pos") > 1).select("ref", (F.col("pos") * 10).cast("long").alias("ord"))
    # named after the member it replaced (a column, not a literal: a literal key
    # would turn the later semi join into a nested loop)
    gone = members.filter(F.col("pos") == 1).select(F.concat(F.lit("0-WITHDRAWN-"), F.col("ref")).alias("ref"),
                                                    F.lit(5).cast("long").alias("ord"))
    return kept.unionByName(gone)


def enum_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-35: enumeration refresh keeps old numbers, appends new members."""
    members = _priority_members(spark, sf_dir)
    return mg.enum_merge(_priority_existing(members), members).select("ref", "ord")


def enum_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-28 / OP-47: orders per enumeration member, members without orders
    kept.  Orders are counted per priority first (map-side combined), so the
    join sees one row per member on each side."""
    members = _priority_members(spark, sf_dir)
    # the enumeration is read from the store, where its refresh wrote it
    store = MirrorStore(spark, snapshot_root(spark, [f"{sf_dir}/orders.parquet"]))
    enum = materialize(store, f"enums/{tb.PRIORITY_ENUM}", mg.enum_merge(_priority_existing(members), members))
    per = _t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("ref")).agg(
        F.count(F.lit(1)).alias("n"))
    return (enum.join(per, "ref", "left")
            .select("ref", "ord", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_orders"))
            .orderBy("ord"))


# ==========================================================================
# The mirrored document end to end (OP-01..03, 06, 22, 23, 27, 30, 48)
# ==========================================================================

def document_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh the order document mirror from landed source pages.

    ``cur`` is the stored mirror as last written; the source now holds ``src``,
    whose responses (pages with half-page overlap) have landed; the pages are
    read, decoded, deduplicated (first arrival) and merged by version.
    """
    desc = tb.document_description(spark)
    current = stored_mirror(spark, sf_dir, "cur")
    load = load_from_pages(landed_pages(spark, sf_dir, "src"), desc)
    return mg.merge_full(current, load, desc.key, desc.version)


def _line_pages(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    """Landed responses of the lines entity set for the orders of one state."""
    def build() -> DataFrame:
        o = _t(spark, sf_dir, "orders")
        li = _t(spark, sf_dir, "lineitem")
        # the narrow lines are numbered, then printed as JSON
        rows = fx.line_rows(li, tb.order_state(o, state), changed=state == "src")
        numbered = with_ordinal(rows, ["l_orderkey", "line_no"], "n", total_name="n_total")
        return fx.land_pages(numbered, fx.line_body(), "n", DOCUMENT_FETCH_SIZE,
                             tb.DOCUMENT_ENTITY + "_" + tb.LINES_PROPERTY, total_col="n_total")
    return landed(spark, f"{tb.DOCUMENT_ENTITY}_{tb.LINES_PROPERTY}@{state}", _document_inputs(sf_dir), build)


def section_entity_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-01/03/30 on the lines section mirrored as its own flat table: the
    stored lines of ``cur`` merged with the landed lines of ``src`` (composite
    key, by value since lines carry no version).  No document is ever one row,
    however many lines it has."""
    desc = tb.lines_description(spark)
    current = ensure_snapshot(spark, f"{tb.LINES_TABLE}@cur", desc, _document_inputs(sf_dir),
                              lambda: _line_pages(spark, sf_dir, "cur"))
    load = load_from_pages(_line_pages(spark, sf_dir, "src"), desc)
    merged = mg.merge_full(current, load, desc.key, version=None, with_action=True)
    return merged.select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"),
                         F.col("НомерСтроки").alias("line_no"),
                         tb.key_of_guid(F.col("Номенклатура")).alias("l_partkey"),
                         F.col("Количество").cast("double").alias("quantity"),
                         F.col("Сумма").cast("double").alias("amount"),
                         "action")


def section_sales_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-27 / OP-48: sales per customer and brand over the refreshed mirror
    (master ⋈ section ⋈ catalog), service-type items left out, top 10."""
    mirror = document_mirror(spark, sf_dir)
    lines = sc.explode_section(mirror.select("Покупатель", "Товары"), "Товары", keep=["Покупатель"])
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    joined = (lines.select(tb.key_of_guid(F.col("Покупатель")).alias("customer"),
                           tb.key_of_guid(F.col("Номенклатура")).alias("p_partkey"), "Сумма")
              .join(part, "p_partkey")
              .filter(F.col("p_type") != EXCLUDED_TYPE))
    agg = joined.groupBy("customer", F.col("p_brand").alias("brand")).agg(F.sum("Сумма").alias("_sales"))
    return (agg.orderBy(F.col("_sales").desc(), "customer", "brand").limit(TOPK)
            .select("customer", "brand", _dbl(F.col("_sales")).alias("sales")))


def materialized_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-21 / OP-49 / OP-53 / OP-54: a parameterised function over the mirror
    (not deletion-marked, first ``lim`` by key), materialised as a snapshot."""
    mirror = document_mirror(spark, sf_dir)

    def first_live(lim: int) -> DataFrame:
        return (mirror.filter(~F.col("ПометкаУдаления"))
                .select(tb.key_of_guid(F.col("Ссылка")).alias("o_orderkey"), F.col("ВерсияДанных").alias("ver"))
                .orderBy("o_orderkey").limit(lim))

    store = MirrorStore(spark, snapshot_root(spark, _document_inputs(sf_dir)))
    return materialize(store, "views/first_live", first_live(VIEW_LIMIT))


def sales_view_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-54 kept up, not recomputed: orders and their total per customer, as
    stored for `cur`, after the change set of the refresh to `src`."""
    desc = tb.document_description(spark)
    group, sums = ["Покупатель"], {"total": lambda r: r("СуммаДокумента")}
    current = stored_mirror(spark, sf_dir, "cur")
    store = MirrorStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/branches/{uuid.uuid4().hex}")
    store.commit("views/customer_sales", inc.grouped(current, group, sums))
    changes = mg.change_set(current, load_from_pages(landed_pages(spark, sf_dir, "src"), desc), desc.key, desc.version)
    view = maintain_view(store, "views/customer_sales", changes, group, sums)
    return view.select(tb.key_of_guid(F.col("Покупатель")).alias("customer"), F.col(inc.ROW_COUNT).cast("long").alias("n_orders"),
                       _dbl(F.col("total")).alias("total"))


# ==========================================================================
# Quality (OP-44..46)
# ==========================================================================

def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-44: one pass of column checks over a mirror candidate built from
    orders, where some rows carry values a mirror column must not hold."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cand = o.select(
        tb.guid_of(k).alias("Ссылка"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(ZERO_GUID)).otherwise(tb.guid_of(F.col("o_custkey"))).alias("Покупатель"),
        F.when(k % 7 == 0, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("Дата"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("Статус"),
        F.struct(F.col("o_orderpriority").alias("value"),
                 F.when(k % 11 == 0, F.lit("Edm.String")).otherwise(F.lit("Перечисление.Приоритеты")).alias("type")
                 ).alias("Приоритет"),
        F.when(k % 13 == 0, F.lit(b"").cast("binary")).otherwise(F.encode(F.col("o_orderstatus"), "UTF-8")).alias("Данные"))
    desc = TableDescription(
        table="Документ.Заказ", kind="Document", entity="Document_Заказ",
        columns=[ColumnDesc("Ref_Key", "Edm.Guid", "Ссылка", "uuid"),
                 ColumnDesc("Покупатель_Key", "Edm.Guid", "Покупатель", "uuid"),
                 ColumnDesc("Date", "Edm.DateTime", "Дата", "timestamp"),
                 ColumnDesc("Статус", "Edm.String", "Статус", "text"),
                 ColumnDesc("Приоритет", "Edm.String", "Приоритет", ty.COMPOSITE),
                 ColumnDesc("Данные_Base64Data", "Edm.Binary", "Данные", "bytea")],
        key=["Ссылка"])
    return qa.check_columns(cand, qa.description_checks(desc))


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-45: (order, line number) is not a key of lineitem."""
    li = _t(spark, sf_dir, "lineitem")
    return qa.pk_violations(li, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", F.col("n_rows").cast("long").alias("n_rows"))


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-46: lines referencing an order the refreshed mirror no longer has."""
    li = _t(spark, sf_dir, "lineitem")
    _, src = _states(spark, sf_dir)
    return qa.fk_violations(li, ["l_orderkey"], src, ["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey")


def deferred_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-46 at commit: lines that a refresh of the order mirror would leave
    without their order, found from the deleted orders of its change set."""
    desc = tb.document_description(spark)
    changes = mg.change_set(stored_mirror(spark, sf_dir, "cur"), load_from_pages(landed_pages(spark, sf_dir, "src"), desc), desc.key, desc.version)
    lines = _t(spark, sf_dir, "lineitem").select(tb.guid_of(F.col("l_orderkey")).alias("Заказ"), "l_orderkey", "l_linenumber", "l_partkey")
    return qa.deferred_fk_violations(lines, ["Заказ"], changes, desc.key).select("l_orderkey", "l_linenumber", "l_partkey")


# ==========================================================================
# Control table (OP-10, OP-55)
# ==========================================================================

def refresh_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-10: control rows with row counts and the pages a refresh needs."""
    ctl = control_table(spark, sf_dir)
    return ctl.select(F.col("table").alias("table_name"), "kind", F.col("fetch_size").cast("long").alias("fetch_size"),
                      "row_count", pg.page_count(F.col("row_count"), F.col("fetch_size")).alias("n_pages"))


def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-10 of a real refresh: what refreshing the order mirror from the landed
    pages inserted, updated, deleted and left, the rows it has then, and whether
    the same refresh once more writes anything."""
    store, desc = _branch(spark, sf_dir)
    rows = []
    for run in (1, 2):
        s = refresh_and_commit(store, desc, landed_pages(spark, sf_dir, "src"), fetch_size=DOCUMENT_FETCH_SIZE)
        rows.append((run, *[s[a] for a in (mg.INSERT, mg.UPDATE, mg.DELETE, mg.SAME)], s["row_count"], s["buckets_written"] > 0, s["duration_ms"] > 0))
    return spark.createDataFrame(rows, "run long, n_insert long, n_update long, n_delete long, n_same long, row_count long, wrote boolean, timed boolean")


def select_refresh_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-55: tables a full bulk refresh visits (enumerations excluded)."""
    return select_refresh(control_table(spark, sf_dir)).select(F.col("table").alias("table_name"), "row_count")


def select_refresh_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-55 ``fast``: only tables smaller than one page."""
    return select_refresh(control_table(spark, sf_dir), fast=True).select(
        F.col("table").alias("table_name"), "row_count")


REGISTRY = {
    "json_to_columns": json_to_columns,
    "json_defaults": json_defaults,
    "zero_to_null": zero_to_null,
    "value_any": value_any_query,
    "type_ref": type_ref_query,
    "map_types": map_types,
    "abbreviate_name": abbreviate_name,
    "key_filter": key_filter,
    "mask_url": mask_url,
    "plan_pages": plan_pages,
    "dedup_first_page": dedup_first_page,
    "page_set_check": page_set_check,
    "build_sections": build_sections,
    "explode_section": explode_section,
    "section_field_array": section_field_array,
    "section_contains": section_contains,
    "section_contains_indexed": section_contains_indexed,
    "section_chunks": section_chunks,
    "section_chunks_explode": section_chunks_explode,
    "section_chunks_contain": section_chunks_contain,
    "section_chunks_refresh": section_chunks_refresh,
    "merge_full": merge_full,
    "merge_change_counts": merge_change_counts,
    "merge_inserts": merge_inserts,
    "merge_deletes": merge_deletes,
    "diff_by_version": diff_by_version,
    "diff_by_value": diff_by_value,
    "refresh_by_key": refresh_by_key,
    "refresh_by_key_documents": refresh_by_key_documents,
    "key_answers_in_batches": key_answers_in_batches,
    "lookup_join": lookup_join,
    "enum_merge": enum_merge,
    "enum_counts": enum_counts,
    "section_sales_topk": section_sales_topk,
    "section_entity_refresh": section_entity_refresh,
    "materialized_view": materialized_view,
    "sales_view_refresh": sales_view_refresh,
    "check_columns": check_columns,
    "pk_violations": pk_violations,
    "fk_violations": fk_violations,
    "deferred_fk_violations": deferred_fk_violations,
    "refresh_stats": refresh_stats,
    "refresh_counts": refresh_counts,
    "select_refresh": select_refresh_all,
    "select_refresh_fast": select_refresh_fast,
}
