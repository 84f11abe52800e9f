"""The user-facing workflow: one object per source (SURVEY §3 entries A–C and
the scheduled refresh), built from the catalog jobs, the page reader, the
merge family and the snapshot store.

    m = Mirror(spark, "/shared/meta/$metadata.xml")
    m.list_objects()                                   # what can be mirrored
    m.create_table("Справочник.Контрагенты", pages)    # schema, views and a first load
    pages = m.fetch_pages("Справочник.Контрагенты", "http://host/InfoBase", user, password)
    m.refresh("Справочник.Контрагенты", pages)         # full soft refresh from the pages
    m.key_requests("Справочник.Контрагенты", keys)     # what to ask the source for these keys
    m.refresh_keys("Справочник.Контрагенты", keys, answers)   # apply the answers as one batch, returns the keys' rows
    m.refresh_all(pages_for, fast=True)                # scheduled bulk refresh
    m.refresh_metadata("Справочник.Контрагенты", pages)   # follow schema changes, reload if needed
    m.table("Справочник.Контрагенты")                  # the current snapshot

Only table descriptions and control rows (one per table) reach the driver.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from mirrorsmith.functions.decode import FAIL_FAST, number_text
from mirrorsmith.functions.literals import PASSWORD_MASK, key_filter, key_term, request_path
from mirrorsmith.operators.merge import enum_merge
from mirrorsmith.plans import catalog as cat
from mirrorsmith.plans import evolve as ev
from mirrorsmith.plans.description import TableDescription
from mirrorsmith.plans.refresh import (CONTROL_SCHEMA, SEQ, append_audit, audit_requests, commit_answers, create_table,
                                       default_fetch_size, lookup, refresh_and_commit, select_refresh)
from mirrorsmith.plans.store import MirrorStore, mirror_root
from mirrorsmith.sources.pages import request_url
from mirrorsmith.streaming.keyed_refresh import decoded_answers, response_schema


class MissingAnswers(ValueError):
    """A requested key has no answer, so nothing is known about it."""


class Mirror:
    def __init__(self, spark: SparkSession, metadata_path: str, root: str | None = None,
                 server: str = "DEFAULT", short_names: bool = False):
        self.spark = spark
        self.server = server
        self.short_names = short_names
        self.metadata_path = metadata_path
        self.store = MirrorStore(spark, root or f"{mirror_root(spark)}/{server}")
        self.entity_types = self.enum_types = None
        self._load_metadata()
        self._descriptions: dict[str, TableDescription] = {}

    # -- metadata ---------------------------------------------------------
    def _load_metadata(self) -> None:
        for old in (self.entity_types, self.enum_types):
            if old is not None:
                old.unpersist()
        ents, cplx, enums = cat.read_metadata_xml(self.spark, self.metadata_path, self.server)
        # metadata is read once and reused (small: one row per entity type)
        self.entity_types = cat.classify_objects(ents, cplx).cache()
        self.enum_types = cat.enum_types(enums).cache()

    def list_objects(self) -> DataFrame:
        return cat.list_objects(self.entity_types, self.enum_types).orderBy("table")

    def describe(self, table: str) -> TableDescription:
        if table not in self._descriptions:
            source = self.enum_types if table.startswith("Перечисление.") else self.entity_types
            # names that this mirror has given to other tables of the kind
            used = [n for t, d in self._descriptions.items() if t.split(".", 1)[0] == table.split(".", 1)[0] and d.view
                    for n in (d.view, *(s.view for s in d.sections.values()))]
            self._descriptions[table] = cat.describe(source, table, self.short_names, used)
        return self._descriptions[table]

    # -- control table ----------------------------------------------------
    def _control_path(self) -> str:
        return f"{self.store.root}/_control"

    def _fetch_size(self, table: str) -> int:
        """The fetch size recorded last for a table."""
        try:
            last = self.control().filter((F.col("server") == self.server) & (F.col("table") == table)).select("fetch_size").first()
        except AnalysisException:   # nothing recorded yet
            last = None
        return int(last["fetch_size"]) if last else default_fetch_size()

    def _record(self, desc: TableDescription, row_count: int | None, started: float | None, fetch_size: int | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = (self.server, desc.table, desc.kind, desc.table.split(".", 1)[0], desc.table.split(".", 1)[-1],
               fetch_size or default_fetch_size(), row_count, now if started else None,
               int((time.time() - started) * 1000) if started else None)
        self.spark.createDataFrame([row], CONTROL_SCHEMA).coalesce(1).write.mode("append").parquet(self._control_path())

    def control(self) -> DataFrame:
        """Latest control row per table (appends are the history)."""
        raw = self.spark.read.schema(CONTROL_SCHEMA).parquet(self._control_path())
        latest = raw.groupBy("server", "table").agg(
            F.max_by(F.struct(*[c for c in raw.columns if c not in ("server", "table")]),
                     F.coalesce(F.col("refresh_data_ts"), F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00")))).alias("_r"))
        return latest.select("server", "table", "_r.*")

    # -- entries ----------------------------------------------------------
    def _is_enum(self, table: str) -> bool:
        return self.describe(table).kind == "Enumeration"

    def _fill_enum(self, table: str) -> int:
        """Enumeration refresh: members of the metadata, order numbers kept."""
        started = time.time()
        desc = self.describe(table)
        ref, order = (c.name for c in desc.columns)
        base = self.store.current_version(table)
        merged = enum_merge(self.store.read(table, desc.spark_schema()).withColumnsRenamed({ref: "ref", order: "ord"}),
                            cat.enum_members(self.enum_types, table)).select(F.col("ref").alias(ref), F.col("ord").alias(order))
        version, rows = self.store.commit(table, merged, bucket_key=desc.key, base=base)
        self.store.prune(table)
        self.store.register(table, desc)
        self._record(desc, rows, started)
        return version

    def create_table(self, table: str, pages: DataFrame | None = None, fetch_size: int | None = None) -> int:
        """Mirror a table: its schema and views, and its rows from ``pages`` (an
        enumeration's from the metadata).  Does nothing to an existing one."""
        desc = self.describe(table)
        if self.store.current_version(table) is not None:
            return create_table(self.store, desc)
        version = create_table(self.store, desc)
        if self._is_enum(table):
            return self._fill_enum(table)
        self._record(desc, None, None)
        return self.refresh(table, pages, fetch_size)["version"] if pages is not None else version

    def table(self, table: str) -> DataFrame:
        desc = self.describe(table)
        return self.store.read(table, desc.spark_schema())

    def refresh(self, table: str, pages: DataFrame, fetch_size: int | None = None) -> dict:
        """Full soft refresh from landed pages (entry B); statistics recorded,
        with the fetch size, which holds for later refreshes that do not give
        one (unless their pages carry it)."""
        desc = self.describe(table)
        started = time.time()
        usual = fetch_size or self._fetch_size(table)
        stats = refresh_and_commit(self.store, desc, pages, fetch_size=fetch_size, usual=usual)
        self._record(desc, stats["row_count"], started, usual)
        return stats

    def key_requests(self, table: str, keys: DataFrame, publication: str = "InfoBase") -> DataFrame:
        """``keys`` (mirror names) with the request of each: ``url`` with a
        typed key filter; a table without a key (constants) is asked whole."""
        desc = self.describe(table)
        terms = [key_term(c.name_src, c.engine, F.col(c.name)) for k in desc.key for c in desc.columns if c.name == k]
        query = F.concat(F.lit("$filter="), key_filter(terms)) if terms else F.lit("")
        requested = keys.select(*desc.key).distinct() if desc.key else self.spark.range(1).select()
        return requested.withColumn("url", request_path(publication, desc.entity, query))

    def refresh_keys(self, table: str, keys: DataFrame, answers: DataFrame) -> DataFrame:
        """Refresh by key (entry C) for a batch of keys: ``keys`` holds the
        requested key columns (mirror names); ``answers`` the source's response
        to each: the key columns, ``body`` and, where responses have an order,
        ``seq``.  A row upserts its key, an empty response deletes it.  A key
        without an answer, or one that cannot be read, raises `MissingAnswers`
        and changes nothing.  Returns the requested keys with their rows, NULL
        where the source has none.  Statistics of full refreshes are not
        touched."""
        desc = self.describe(table)
        schema = response_schema(desc)["value"].dataType
        asked = keys.select(*desc.key).distinct()
        seq = F.col("seq").cast("long") if "seq" in answers.columns else F.lit(None).cast("long")
        given = answers.select(*desc.key, "body", seq.alias(SEQ))
        missing = asked.join(given.filter("body IS NOT NULL"), desc.key, "left_anti")
        lost = missing.limit(5).collect()
        if lost:
            raise MissingAnswers(f"{table}: no answer for " + "; ".join(str(tuple(r)) for r in lost))
        last = given.join(asked, desc.key, "left_semi").withColumn("_n", F.row_number().over(
            Window.partitionBy(*desc.key).orderBy(F.col(SEQ).desc_nulls_last(), F.col("body").desc()))).filter("_n = 1")
        rows = F.from_json(number_text(F.col("body"), schema), T.StructType([T.StructField("value", schema)]), FAIL_FAST).getField("value")
        value = F.coalesce(rows, F.raise_error(F.lit("a key response has no value")).cast(schema))
        commit_answers(self.store, table, decoded_answers(last.select(*desc.key, SEQ, value.alias("v")), desc, schema.elementType), desc.key)
        self.store.prune(table)
        self.store.register(table, desc)
        return self.lookup(table, asked)

    def lookup(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows of some keys, NULL where the mirror has none; only the
        buckets that the keys fall into are read."""
        desc = self.describe(table)
        return lookup(self.store, table, keys.select(*desc.key).distinct(), desc.key)

    def fetch_pages(self, table: str, base_url: str, user: str = "", password: str = "",
                    pages_per_partition: int = 16) -> DataFrame:
        """Pages of a full read from the live source (`sources/odata.py`): page
        ranges in tasks, rounds of ranges until a short page, landed in the
        mirror's folder before they are used, so no retry asks the source again.
        The row count of the control table only sizes the first round.  The
        requests are appended to the request log without the password."""
        from mirrorsmith.sources.odata import scan
        desc = self.describe(table)
        ctl = self.control().filter((F.col("server") == self.server) & (F.col("table") == table)).select("row_count", "fetch_size").first()
        fetch_size = int(ctl["fetch_size"]) if ctl else default_fetch_size()
        sort = ",".join(desc.sort)
        options = {"base_url": base_url, "entity": desc.entity, "sort": sort, "fetch_size": str(fetch_size),
                   "pages_per_partition": str(pages_per_partition), "user": user, "password": password}
        pages = scan(self.spark, options, f"{self.store.root}/_landed/{table}/{uuid.uuid4().hex}", ctl["row_count"] if ctl else None)
        scheme, rest = base_url.split("://", 1) if "://" in base_url else ("http", base_url)
        shown = f"{scheme}://{user}:{PASSWORD_MASK}@{rest}" if user else base_url
        sent = pages.select(request_url(F.lit(desc.entity), F.lit(sort), F.col("skip"), F.lit(fetch_size)).alias("url"))
        append_audit(self.store, audit_requests(sent, shown, self.server, user or "anonymous", masked=True))
        return pages

    def refresh_all(self, pages_for, fast: bool = False) -> list[dict]:
        """Scheduled bulk refresh: the selected tables in name order
        (``pages_for(table)`` returns that table's landed pages).  A table that
        cannot be refreshed is reported with its ``error``."""
        out = []
        for r in select_refresh(self.control().filter(F.col("server") == self.server), fast=fast).collect():
            try:
                out.append({"table": r["table"], **self.refresh(r["table"], pages_for(r["table"]))})
            except Exception as e:  # noqa: BLE001 - one refused table does not stop the others
                out.append({"table": r["table"], "error": f"{type(e).__name__}: {e}"})
        return out

    def refresh_metadata(self, table: str, pages: DataFrame | None = None, fetch_size: int | None = None) -> dict:
        """Follow schema changes: re-read the metadata, diff against the current
        snapshot.  An unchanged table is left alone, a dropped column leaves the
        files as they are; an added or retyped one empties the table,
        which is then reloaded from ``pages`` (or by the next refresh).  An
        enumeration takes the members of the new metadata."""
        self._load_metadata()
        self._descriptions.pop(table, None)
        desc = self.describe(table)
        if self._is_enum(table):
            self._fill_enum(table)
            return {"reload": False, "add": [], "drop": [], "retype": [], "same": [c.name for c in desc.columns]}
        base = self.store.current_version(table)
        current = self.store.read(table, desc.spark_schema())
        changes = ev.plan_changes(self.spark, desc, current.schema)
        projected, reload = ev.apply_schema(current, desc)
        if reload:
            self.store.commit(table, projected, bucket_key=desc.key, base=base)
        elif changes["drop"]:
            self.store.alter(table, drop=changes["drop"])   # no file is written
        if changes["drop"] or reload:
            self.store.prune(table)
            self.store.register(table, desc)
        if reload and pages is not None:
            self.refresh(table, pages, fetch_size)
        return {"reload": reload, **changes}
