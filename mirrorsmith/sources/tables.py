"""The given tables, and source states derived from them.

The mirrored object used throughout is an order *document* with its lines as
a tabular section, the shape the source platform sends: ``orders`` gives the
header, ``lineitem`` the section.  Two states of the source are derived from
the whole ``orders`` table (every row takes part in one or both):

* ``cur`` — what the mirror holds: every order whose key is not ``≡ 0 (mod 10)``
  (those are new at the source), version ``<key>-false``;
* ``src`` — what the source holds now: every order whose key is not
  ``≡ 1 (mod 10)`` (those were deleted); keys ``≡ 2`` have a new total and a new
  version ``<key>-true``; keys ``≡ 3`` have a lower-cased status but the old
  version, a change that only value comparison sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mirrorsmith.functions.types import DOUBLE_SCALE
from mirrorsmith.plans.description import TableDescription

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

DOCUMENT_TABLE = "Документ.Заказ"
DOCUMENT_ENTITY = "Document_Заказ"
LINES_PROPERTY = "Товары"
PRIORITY_ENUM = "Приоритеты"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, as the reader splits it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# FIXED VALUES: first hex digit of generated GUIDs (never the empty GUID).
GUID_TAG = "a"


def guid_of(num: Column) -> Column:
    """Deterministic GUID text for a non-negative integer key: the tag digit,
    then the key in hex, zero-padded (key 0 is not the empty GUID)."""
    h = F.concat(F.lit(GUID_TAG), F.substring(F.lpad(F.lower(F.hex(num)), 32, "0"), 2, 31))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def key_of_guid(g: Column) -> Column:
    """Inverse of `guid_of`."""
    return F.conv(F.substring(F.regexp_replace(g, "-", ""), 2, 31), 16, 10).cast("long")


# --------------------------------------------------------------------------
# Flat states of orders (what a decoded mirror holds)
# --------------------------------------------------------------------------

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_state(orders: DataFrame, which: str) -> DataFrame:
    """``cur`` or ``src`` state of the orders (see module doc), with ``ver``."""
    k = F.col("o_orderkey")
    o = orders.select(*ORDER_COLS)
    if which == "all":
        return o.withColumn("ver", F.concat(k.cast("string"), F.lit("-false")))
    if which == "cur":
        return o.filter(k % 10 != 0).withColumn("ver", F.concat(k.cast("string"), F.lit("-false")))
    if which != "src":
        raise ValueError(which)
    return (o.filter(k % 10 != 1)
            .withColumn("o_totalprice", F.when(k % 10 == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
            .withColumn("o_orderstatus", F.when(k % 10 == 3, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")))
            .withColumn("ver", F.concat(k.cast("string"), F.lit("-"), F.when(k % 10 == 2, "true").otherwise("false"))))


# --------------------------------------------------------------------------
# The order document as the source sends it
# --------------------------------------------------------------------------

# FIXED VALUES: the source metadata of the order document and its lines
# section, as (property name, source type); keys are listed separately.
DOCUMENT_PROPERTIES = [
    ("Ref_Key", "Edm.Guid"),
    ("DataVersion", "Edm.String"),
    ("DeletionMark", "Edm.Boolean"),
    ("Number", "Edm.String"),
    ("Date", "Edm.DateTime"),
    ("Posted", "Edm.Boolean"),
    ("Покупатель_Key", "Edm.Guid"),
    ("Статус", "Edm.String"),
    ("СуммаДокумента", "Edm.Double"),
    ("Приоритет", "Edm.String"),
    ("Приоритет_Type", "Edm.String"),
    ("Товары", "Collection(StandardODATA.Document_Заказ_Товары_RowType)"),
]
DOCUMENT_KEYS = ["Ref_Key"]
LINE_PROPERTIES = [
    ("Ref_Key", "Edm.Guid"),
    ("LineNumber", "Edm.Int64"),
    ("Номенклатура_Key", "Edm.Guid"),
    ("Поставщик_Key", "Edm.Guid"),
    ("Количество", "Edm.Double"),
    ("Сумма", "Edm.Double"),
    ("Скидка", "Edm.Double"),
    ("Налог", "Edm.Double"),
    ("ПризнакВозврата", "Edm.String"),
    ("СтатусСтроки", "Edm.String"),
    ("ДатаОтгрузки", "Edm.DateTime"),
]
LINE_KEYS = ["Ref_Key", "LineNumber"]
# line fields of `lineitem` in the order that numbers the lines of an order
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def document_entity_rows(spark: SparkSession, server: str = "DEFAULT") -> DataFrame:
    """Entity rows (as the metadata scan yields them) for the order document."""
    rows = [(server, DOCUMENT_ENTITY, [{"name": n, "type": t} for n, t in DOCUMENT_PROPERTIES], DOCUMENT_KEYS),
            (server, DOCUMENT_ENTITY + "_" + LINES_PROPERTY,
             [{"name": n, "type": t} for n, t in LINE_PROPERTIES], LINE_KEYS)]
    return spark.createDataFrame(rows, "server string, name string, properties array<struct<name:string,type:string>>, "
                                       "keys array<string>")


_DESCRIPTIONS: dict[tuple[str, str], TableDescription] = {}


def document_description(spark: SparkSession) -> TableDescription:
    """Description of the order document, derived once per session (the
    metadata is read once and reused, like a per-transaction cache)."""
    from mirrorsmith.plans.catalog import classify_objects, describe
    cache_key = (spark.sparkContext.applicationId, DOCUMENT_TABLE)
    if cache_key not in _DESCRIPTIONS:
        ents = document_entity_rows(spark)
        _DESCRIPTIONS[cache_key] = describe(classify_objects(ents, ents.limit(0)), DOCUMENT_TABLE).with_scale(DOUBLE_SCALE)
    return _DESCRIPTIONS[cache_key]


LINES_TABLE = DOCUMENT_TABLE + "_" + LINES_PROPERTY


def lines_description(spark: SparkSession) -> TableDescription:
    """Description of the lines section as its own entity set (flat rows
    keyed by order and line number), derived by the same catalog jobs."""
    from mirrorsmith.plans.catalog import classify_objects, describe
    cache_key = (spark.sparkContext.applicationId, LINES_TABLE)
    if cache_key not in _DESCRIPTIONS:
        ents = document_entity_rows(spark)
        _DESCRIPTIONS[cache_key] = describe(classify_objects(ents, ents.limit(0)), LINES_TABLE).with_scale(DOUBLE_SCALE)
    return _DESCRIPTIONS[cache_key]


