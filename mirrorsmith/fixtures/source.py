"""The source that the queries and tests read from, made from the given tables.

Stands in for the source platform, which cannot be reached here: order
documents, their lines and events as JSON objects, numbered in paging order and
cut into overlapping pages.  No part of the engine; its operators start where
the pages have landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mirrorsmith.functions.constants import ZERO_DATETIME, ZERO_GUID
from mirrorsmith.sources.pages import page_count
from mirrorsmith.sources.tables import ISO_SECONDS, LINE_ORDER, LINES_PROPERTY, PRIORITY_ENUM, guid_of


def land_pages(rows: DataFrame, json_col: str | Column, ordinal_col: str, fetch_size: int, table: str,
               later_copy=None, total_col: str | None = None) -> DataFrame:
    """Source responses for rows already numbered in paging order.

    A row at position ``n`` is returned by every page ``k`` with
    ``k*step <= n < k*step + F``; ``later_copy`` (JSON column → JSON column)
    may alter the copies after the first one, as a row changed at the source
    between two requests would be.  A page holds at most ``F`` rows, so each
    `collect_list` group is bounded by the fetch size.

    Each task prints a run of consecutive pages.  Rows are exchanged once, but
    for those at the borders of runs, and before they are printed where
    ``json_col`` is an expression over them.
    """
    step = (fetch_size + 1) // 2
    n = F.col(ordinal_col)
    total = F.col(total_col) if total_col else rows.agg(F.count(F.lit(1)).cast("long")).scalar()
    last_page = page_count(total, F.lit(fetch_size)) - 1
    first = F.greatest(F.lit(0).cast("long"), F.ceil((n - fetch_size + 1) / step).cast("long"))
    last = F.least(F.floor(n / step).cast("long"), last_page)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = lambda page: F.floor(page * tasks / F.col("_pages")).cast("int")
    json = F.col(json_col) if isinstance(json_col, str) else json_col
    dealt = rows.withColumns({"_n": n, "_first": first, "_last": last, "_pages": last_page + 1}) \
        .withColumn("_run", F.explode(F.sequence(run(F.col("_first")), run(F.col("_last"))))).repartitionById(tasks, F.col("_run"))
    copies = dealt.select("_run", "_n", "_first", "_last", "_pages", json.alias("_json")) \
        .select("*", F.explode(F.sequence("_first", "_last")).alias("page_no")).filter(run(F.col("page_no")) == F.col("_run"))
    body = F.col("_json")
    if later_copy is not None:
        body = F.when(F.col("page_no") > F.col("_first"), later_copy(body)).otherwise(body)
    placed = copies.select("_run", "page_no", (F.col("_n") - F.col("page_no") * step).alias("pos"), body.alias("_json"))
    grouped = placed.groupBy("_run", "page_no").agg(F.array_sort(F.collect_list(F.struct("pos", "_json"))).alias("_rows"))
    return grouped.select(
        F.lit(table).alias("table"),
        F.col("page_no").cast("int").alias("page_no"),
        (F.col("page_no") * step).cast("long").alias("skip"),
        F.concat(F.lit('{"value":['), F.array_join(F.transform("_rows", lambda r: r.getField("_json")), ","),
                 F.lit("]}")).alias("body"))


def line_rows(lineitem: DataFrame, state: DataFrame, changed: bool = False) -> DataFrame:
    """The lines of the orders in ``state``, numbered per order in `LINE_ORDER`
    order by a window over the order's lines (streamed and spillable, never
    gathered into one value).  With ``changed``, the lines of orders ≡ 2
    (mod 10) have one more unit, as at the source now."""
    lines = lineitem.join(state.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi") \
        .select("l_orderkey", *LINE_ORDER)
    out = lines.withColumn("line_no", F.row_number().over(
        Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)).cast("long"))
    more = F.when(F.col("l_orderkey") % 10 == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return out.withColumn("l_quantity", more) if changed else out


def line_body() -> Column:
    """The source JSON object of a line of `line_rows`."""
    return F.to_json(F.struct(
        guid_of(F.col("l_orderkey")).alias("Ref_Key"),
        F.col("line_no").cast("string").alias("LineNumber"),
        guid_of(F.col("l_partkey")).alias("Номенклатура_Key"),
        guid_of(F.col("l_suppkey")).alias("Поставщик_Key"),
        F.col("l_quantity").alias("Количество"),
        F.col("l_extendedprice").alias("Сумма"),
        F.col("l_discount").alias("Скидка"),
        F.col("l_tax").alias("Налог"),
        F.col("l_returnflag").alias("ПризнакВозврата"),
        F.col("l_linestatus").alias("СтатусСтроки"),
        _iso(F.col("l_shipdate")).alias("ДатаОтгрузки")))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def order_lines(lineitem: DataFrame) -> DataFrame:
    """(l_orderkey, lines) — the lines of each order in `LINE_ORDER` order, as
    they are in the table (see `_section`).  One group per document."""
    return lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE_ORDER))).alias("lines"))


def _section(lines: Column) -> Column:
    """The lines of an order as source JSON structs, numbered 1.."""
    def line(x: Column, i: Column) -> Column:
        return F.struct(
            (i + 1).cast("string").alias("LineNumber"),
            guid_of(x.getField("l_partkey")).alias("Номенклатура_Key"),
            guid_of(x.getField("l_suppkey")).alias("Поставщик_Key"),
            x.getField("l_quantity").alias("Количество"),
            x.getField("l_extendedprice").alias("Сумма"),
            x.getField("l_discount").alias("Скидка"),
            x.getField("l_tax").alias("Налог"),
            x.getField("l_returnflag").alias("ПризнакВозврата"),
            x.getField("l_linestatus").alias("СтатусСтроки"),
            _iso(x.getField("l_shipdate")).alias("ДатаОтгрузки"))

    return F.transform(lines, line)


def document_rows(state: DataFrame, lines: DataFrame) -> DataFrame:
    """The orders of a state with their lines (NULL without any)."""
    return state.join(lines, state["o_orderkey"] == lines["l_orderkey"], "left").drop("l_orderkey")


def document_body(lines: bool = True) -> Column:
    """The source JSON object of an order of `document_rows`.

    Orders without lines have no ``Товары`` field at all (decoded as ``[]``).
    """
    k = F.col("o_orderkey")
    fields = [
        guid_of(k).alias("Ref_Key"),
        F.col("ver").alias("DataVersion"),
        (F.upper("o_orderstatus") == "P").alias("DeletionMark"),
        F.lpad(k.cast("string"), F.greatest(F.lit(9), F.length(k.cast("string"))), F.lit("0")).alias("Number"),
        _iso(F.col("o_orderdate")).alias("Date"),
        (F.upper("o_orderstatus") == "F").alias("Posted"),
        guid_of(F.col("o_custkey")).alias("Покупатель_Key"),
        F.col("o_orderstatus").alias("Статус"),
        F.col("o_totalprice").alias("СуммаДокумента"),
        F.col("o_orderpriority").alias("Приоритет"),
        F.lit("StandardODATA." + PRIORITY_ENUM).alias("Приоритет_Type"),
    ]
    if lines:
        fields.append(_section(F.col("lines")).alias(LINES_PROPERTY))
    return F.to_json(F.struct(*fields))


def document_json(state: DataFrame, lines: DataFrame | None, keep: list[str] | None = None) -> DataFrame:
    """(o_orderkey, json) — one source JSON object per order of a state."""
    rows = state if lines is None else document_rows(state, lines)
    return rows.select("o_orderkey", *(keep or []), document_body(lines is not None).alias("json"))


def event_json(ev: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Events as the source would send them, with empty values where the
    event type says so (JSON nulls are simply left out)."""
    t = F.col("event_type")
    fields = [
        guid_of(F.col("event_id")).alias("Ref_Key"),
        F.when(F.col("user_id") % 5 == 0, F.lit(ZERO_GUID)).otherwise(guid_of(F.col("user_id"))).alias("User_Key"),
        F.when(t == "error", F.lit(ZERO_DATETIME))
         .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("Period"),
        F.when(t != "view", F.col("value")).alias("Value"),
        F.when(t != "signup", t == "purchase").alias("Success"),
        F.when(t != "click", t).alias("Kind"),
        F.when(t == "error", F.lit("")).otherwise(F.base64(F.encode(t, "UTF-8"))).alias("Data_Base64Data"),
    ]
    return ev.select("event_id", *(keep or []), F.to_json(F.struct(*fields)).alias("json"))


def altered(json: Column) -> Column:
    """A later copy of a row, changed at the source between two requests."""
    return F.regexp_replace(json, '"Kind":"', '"Kind":"changed-')
