"""Paged source scan (OP-01) and page request planning (OP-02).

The source returns an entity in pages of ``fetch_size`` rows ordered by the
sort columns; the next page starts half a page later, ``step = (F + 1) / 2``,
so consecutive pages overlap and a row changed or inserted during the scan is
not missed.  Reading stops at the first page with fewer than ``F`` rows:

    pages(N, F) = 1                         if N < F
                = floor((N - F) / step) + 2 otherwise

Landed pages are rows ``(table, page_no, skip, body)`` where ``body`` is the
JSON response ``{"value": [row, ...]}``, and ``fetch_size`` where it is known;
they can live in any Spark-readable place (here: text files partitioned by page
number).  Reading a page set is
`from_json` + `posexplode`: page number and position inside the page are
kept, because the dedup keeps the first arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from mirrorsmith.functions.decode import FAIL_FAST, number_text
from mirrorsmith.functions.literals import request_path

PAGE_SCHEMA = "table string, page_no int, skip bigint, body string"

# How landed pages are written.  A body is a whole response, often over a megabyte.
# Parquet's defaults first look at the size after 100 rows and end a group of
# rows at 128 MB compressed; its reader takes up to 4,096 rows of a group at once.
# So the sizes are looked at after each row, and groups end before 8 MB.  A group is one
# Parquet page of several bodies: half of each is in the one before, which zstd sees
# within two megabytes.
LANDED_OPTIONS = {"parquet.block.size": str(8 << 20), "parquet.page.size": str(16 << 20), "parquet.page.size.row.check.min": "1",
                  "parquet.enable.dictionary": "false", "compression": "zstd"}


def page_step(fetch_size: Column) -> Column:
    return F.floor((fetch_size + 1) / 2).cast("long")


def page_count(n_rows: Column, fetch_size: Column) -> Column:
    step = page_step(fetch_size)
    return F.when(n_rows < fetch_size, F.lit(1)).otherwise(F.floor((n_rows - fetch_size) / step) + 2).cast("long")


def plan_requests(tables: DataFrame, publication: str = "InfoBase") -> DataFrame:
    """One row per request of a full refresh.

    ``tables`` needs ``entity``, ``sort`` (comma-separated source names, may be
    empty), ``fetch_size`` and ``row_count`` (rows the source holds).  Output:
    the input columns plus ``page_no``, ``skip``, ``top``, ``rows`` (rows the
    page returns) and ``url``.
    """
    step = page_step(F.col("fetch_size"))
    pages = page_count(F.col("row_count"), F.col("fetch_size"))
    planned = tables.withColumn("page_no", F.explode(F.sequence(F.lit(0).cast("long"), pages - 1)))
    skip = F.col("page_no") * step
    return (planned
            .withColumn("skip", skip)
            .withColumn("top", F.col("fetch_size").cast("long"))
            .withColumn("rows", F.least(F.col("top"), F.greatest(F.lit(0).cast("long"), F.col("row_count") - skip)))
            .withColumn("url", request_url(F.col("entity"), F.col("sort"), F.col("skip"), F.col("fetch_size"),
                                           publication)))


def request_url(entity: Column, sort: Column, skip: Column, fetch_size: Column, publication: str = "InfoBase") -> Column:
    """``/<publication>/odata/standard.odata/<entity>?$orderby=..&$skip=..&$top=..``"""
    order = F.when(F.coalesce(sort, F.lit("")) != "",
                   F.concat(F.lit("$orderby="), sort, F.lit("&"))).otherwise(F.lit(""))
    query = F.concat(order, F.lit("$skip="), skip.cast("string"), F.lit("&$top="), fetch_size.cast("string"))
    return request_path(publication, entity, query)


def read_pages(pages: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Rows of landed pages: ``(table, page_no, pos, row)`` with ``row`` parsed
    by ``row_schema`` (numbers straight into their types, never via double).

    A cut body, a body without ``value`` (an error answer) or a number that its
    type cannot hold stops the job.
    """
    array = T.ArrayType(row_schema)
    resp = T.StructType([T.StructField("value", array)])
    # coalesce, not a test: the parsed array is named once and parsed once
    missing = F.raise_error(F.concat(F.lit("page "), F.col("page_no").cast("string"), F.lit(" of "), F.col("table"),
                                     F.lit(" has no rows field"))).cast(array)
    rows = F.coalesce(F.from_json(number_text(F.col("body"), resp), resp, FAIL_FAST).getField("value"), missing)
    parsed = pages.select("table", "page_no", rows.alias("_rows"))
    # posexplode_outer + null filter: plain posexplode makes the optimizer push
    # an inferred size(from_json(body)) > 0 into the scan, parsing every body twice
    return (parsed.select("table", "page_no", F.posexplode_outer("_rows").alias("pos", "row"))
            .filter(F.col("row").isNotNull()))


OK, CORRUPT, GAP, SHORT, NO_SHORT_PAGE = "ok", "corrupt", "gap", "short", "no short page"


class IncompleteLoad(ValueError):
    """The pages are not one complete read of the source."""


def page_states(pages: DataFrame, fetch_size: int) -> DataFrame:
    """(page_no, n_rows, state) of a page set, one row per page and per gap.

    ``corrupt``: no readable rows; ``gap``: the first number missing after a
    page (or 0); ``short``: fewer rows than the fetch size before the last
    page; ``no short page``: the last page is full, so reading stopped early.
    """
    have = (pages.select(F.col("page_no").cast("long").alias("page_no"),
                         F.json_array_length(F.get_json_object("body", "$.value")).cast("long").alias("n_rows"))
            .groupBy("page_no").agg(F.when(F.count("n_rows") == F.count(F.lit(1)), F.min("n_rows")).alias("n_rows")))
    last = have.agg(F.max("page_no")).scalar()
    full = F.col("n_rows") >= fetch_size
    state = (F.when(F.col("n_rows").isNull(), CORRUPT)
             .when((F.col("page_no") == last) & full, NO_SHORT_PAGE)
             .when((F.col("page_no") < last) & ~full, SHORT).otherwise(OK))
    # the page that should follow each page but the last, and page 0
    expected = have.filter(F.col("page_no") < last).select((F.col("page_no") + 1).alias("page_no")) \
        .unionByName(have.sparkSession.range(1).withColumnRenamed("id", "page_no"))
    gaps = expected.join(have.select("page_no"), "page_no", "left_anti") \
        .select("page_no", F.lit(None).cast("long").alias("n_rows"), F.lit(GAP).alias("state"))
    return have.select("page_no", "n_rows", state.alias("state")).unionByName(gaps)


def check_page_set(pages: DataFrame, fetch_size: int | None = None, default: int = 10000) -> None:
    """Raise `IncompleteLoad` unless ``pages`` are one complete read.

    Without a fetch size it is the one landed with the pages, else that of the
    fullest page, or ``default`` if there is one page only.  Called before a
    merge, which deletes what a load lacks.
    """
    if fetch_size is None and "fetch_size" in pages.columns:
        fetch_size = pages.agg(F.max("fetch_size")).first()[0]
    if fetch_size is None:
        n, most = pages.agg(F.countDistinct("page_no"),
                            F.max(F.json_array_length(F.get_json_object("body", "$.value")))).first()
        fetch_size = most if n > 1 and most else default
    bad = page_states(pages, fetch_size).filter(F.col("state") != OK)
    found = bad.orderBy("page_no").limit(5).collect()
    if found:
        raise IncompleteLoad("; ".join(f"page {r['page_no']}: {r['state']}" for r in found))


def write_pages(pages: DataFrame, path: str) -> None:
    """Land pages as parquet rows ``(page_no, skip, body)``, with the fetch size
    if the pages have it, partitioned by table.

    One row per response; a directory per page would not survive millions of
    pages.  Nothing is overwritten: a landing goes to a fresh path.
    """
    pages.select("table", "page_no", "skip", "body", *[c for c in pages.columns if c == "fetch_size"]) \
        .write.mode("errorifexists").partitionBy("table").options(**LANDED_OPTIONS).parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages back as page rows."""
    raw = spark.read.parquet(path)
    return raw.select(F.col("table").cast("string"), F.col("page_no").cast("int"), F.col("skip").cast("long"), "body",
                      *[F.col(c).cast("int") for c in raw.columns if c == "fetch_size"])


def read_response_files(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Raw response files, one response body per line, named ``<page_no>.json``
    (page number from the file name)."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_f"))
    return raw.select(F.lit(table).alias("table"),
                      F.regexp_extract("_f", r"^(\d+)", 1).cast("int").alias("page_no"),
                      F.lit(None).cast("long").alias("skip"), F.col("value").alias("body"))
