"""Live paged source as a Spark data source, and scans of unknown length (OP-01).

    spark.dataSource.register(PagedSource)
    pages = (spark.read.format("mirror_pages")
             .option("base_url", "http://host:80/InfoBase")   # or file:///shared/landed
             .option("entity", "Catalog_Контрагенты")
             .option("sort", "Ref_Key")
             .option("fetch_size", 10000)
             .option("first_page", 0).option("last_page", 127)
             .load())

Rows are ``(table, page_no, skip, body)``, the landed-page shape that
`mirrorsmith.sources.pages.read_pages` decodes.  A range of pages (half-page
steps, see `pages.page_count`) is cut into partitions of
``pages_per_partition`` pages, so executors fetch pages in parallel instead of
one blocking request after another; a task fetches no page outside its range and
stops at the first short one.

`scan` reads a source whose length is not known: rounds of page ranges, each
range twice as long as the one before and a job of its own, until a round meets
a page with fewer rows than the fetch size.  What lies behind the first such
page is discarded, as the source's own stop rule has it.  The row count of the
last refresh only sizes the first round, so a source that has shrunk or grown
many times over is read whole, without a long tail for one task.

``file://`` bases read ``<base>/<entity>/<skip>.json`` (responses landed by an
earlier fetch, or test fixtures; the folder must be one that all executors see);
``http(s)://`` bases send the request with basic authentication from the
``user`` / ``password`` options.
"""

from __future__ import annotations

import base64
import json
import os
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from mirrorsmith.sources.pages import IncompleteLoad, read_landed, write_pages

SCHEMA = "table string, page_no int, skip bigint, body string"
SERVICE_PATH = "/odata/standard.odata/"


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def _page_count(n: int, f: int) -> int:
    step = (f + 1) // 2
    return 1 if n < f else (n - f) // step + 2


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["base_url"].rstrip("/")
        self.entity = options["entity"]
        self.sort = options.get("sort", "")
        self.fetch_size = int(options.get("fetch_size", 10000))
        self.per_partition = int(options.get("pages_per_partition", 16))
        self.user = options.get("user", "")
        self.password = options.get("password", "")
        self.first = int(options.get("first_page", 0))
        self.last = int(options.get("last_page", self.first + self.per_partition - 1))

    # -- requests ---------------------------------------------------------
    def _query(self, skip: int) -> str:
        order = f"$orderby={self.sort}&" if self.sort else ""
        return f"{order}$skip={skip}&$top={self.fetch_size}"

    def _get(self, path_and_query: str, file_name: str) -> str:
        if self.base.startswith("file://"):
            local = urllib.parse.unquote(urllib.parse.urlparse(self.base).path)
            with open(os.path.join(local, self.entity, file_name), encoding="utf-8") as f:
                return f.read()
        url = self.base + SERVICE_PATH + urllib.parse.quote(path_and_query, safe="/?&=$,")
        req = urllib.request.Request(url, headers={"Accept": "application/json"})
        if self.user:
            token = base64.b64encode(f"{self.user}:{self.password}".encode()).decode()
            req.add_header("Authorization", "Basic " + token)
        with urllib.request.urlopen(req, timeout=600) as resp:
            return resp.read().decode("utf-8")

    def page(self, page_no: int) -> tuple[str | None, int, int | None]:
        """(body, skip, rows) of one page; a landed response that is not there has no body."""
        skip = page_no * ((self.fetch_size + 1) // 2)
        try:
            body = self._get(f"{self.entity}?{self._query(skip)}", f"{skip}.json")
        except FileNotFoundError:
            return None, skip, None
        return body, skip, len(json.loads(body)["value"])

    # -- Spark reader -----------------------------------------------------
    def partitions(self):
        return [PageRange(i, min(self.last, i + self.per_partition - 1)) for i in range(self.first, self.last + 1, self.per_partition)]

    def read(self, partition: PageRange):
        for page_no in range(partition.first, partition.last + 1):
            body, skip, rows = self.page(page_no)
            yield (self.entity, page_no, skip, body)
            if rows is None or rows < self.fetch_size:
                return                                  # a short page ends the scan


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mirror_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


MOST_PAGES_A_ROUND = 1 << 20


def scan(spark: SparkSession, options: dict[str, str], path: str, expected_rows: int | None = None) -> DataFrame:
    """All pages of an entity up to its first short one, landed under ``path``.

    ``expected_rows`` sizes the first round alone; without it a round starts
    with one partition's pages.  Raises `IncompleteLoad` if a landed response is
    missing before the end.
    """
    spark.dataSource.register(PagedSource)
    fetch_size = int(options["fetch_size"])
    size = int(options.get("pages_per_partition", 16)) if expected_rows is None else _page_count(expected_rows, fetch_size)
    first, folders, end = 0, [], None
    rows = F.json_array_length(F.get_json_object("body", "$.value"))
    while end is None:
        size = min(size, MOST_PAGES_A_ROUND)
        ranged = {**options, "first_page": str(first), "last_page": str(first + size - 1)}
        folders.append(f"{path}/round={len(folders)}")
        write_pages(spark.read.format(PagedSource.name()).options(**ranged).load().withColumn("fetch_size", F.lit(fetch_size)), folders[-1])
        got = read_landed(spark, folders[-1])
        end, lost = got.agg(F.min(F.when(rows < fetch_size, F.col("page_no"))), F.min(F.when(F.col("body").isNull(), F.col("page_no")))).first()
        if lost is not None and (end is None or lost < end):
            raise IncompleteLoad(f"page {lost}: no response")
        first, size = first + size, size * 2
    pages = read_landed(spark, folders[0])
    for folder in folders[1:]:
        pages = pages.unionByName(read_landed(spark, folder))
    return pages.filter(F.col("page_no") <= end)
