"""Versioned storage of mirrors: buckets of files, one manifest per version.

A table's rows lie in ``<root>/<table>/rows/<generation>/b=<bucket>/``; the
bucket is the key's hash, as Spark's bucketed tables have it.  A version is a
manifest ``<root>/<table>/_versions/<n>.json`` that says which generation holds
each bucket, so a refresh writes only the buckets that changed and lists the
others again.  A manifest appears whole and at most once per number: the writer
that creates number n + 1 wins, any other merged from an old version and gets
`StaleBase`.  Nothing is overwritten, so a failed write leaves only files that
no manifest names.

Beside the rows a table may have other parts (`ANSWERS`: the last answer of each
key; value indexes), published by the same manifest.  Files name their columns
by number; the manifest gives the numbers their names, so a column is dropped or
renamed without touching a file, and one that is added again is a new number.

The root must be a shared folder that outlives the application (`mirror_root`).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mirrorsmith.plans.description import TableDescription
from mirrorsmith.session import checkpoint_dir, writing

ROWS, ANSWERS = "rows", "answers"
VERSIONS = "_versions"
BUCKET = "b"
KEEP_VERSIONS = 4
ABANDONED_S = 24 * 3600     # files that no manifest names are left alone for this long
ROOT_SETTING = "spark.mirrorsmith.root"


def mirror_root(spark: SparkSession) -> str:
    """Where mirrors, the control table and stream progress live.

    A cluster names a folder in ``spark.mirrorsmith.root``: the checkpoint
    folder is new for each application, so a mirror there would be lost at the
    next start.  Unset, a local run (tests) uses the checkpoint folder.
    """
    root = spark.conf.get(ROOT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {ROOT_SETTING} to a shared folder that outlives the application")
    return checkpoint_dir(spark).rstrip("/") + "/mirror"


class StaleBase(RuntimeError):
    """Another writer committed a version since the one that was merged from."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bucket_of(key: list[str], buckets: int) -> Column:
    """Bucket of a row, as Spark's bucketed tables number them."""
    return F.pmod(F.hash(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


class MirrorStore:
    """Versions of tables under one shared root."""

    def __init__(self, spark: SparkSession, root: str | None = None, keep: int = KEEP_VERSIONS):
        self.spark = spark
        self.root = (root or mirror_root(spark)).rstrip("/")
        self.keep = keep
        self._manifests: dict[tuple[str, int], dict] = {}

    # -- files ------------------------------------------------------------
    def _dir(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(), self._path(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _create(self, path: str, text: str) -> bool:
        """Create a file with this text, whole and only if it is not there."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        out = fs.create(self._path(draft), False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        try:
            if fs.getScheme() == "file":
                # A local rename replaces its target; a hard link does not.
                where = lambda p: fs.pathToFile(self._path(p)).toPath()
                jvm.java.nio.file.Files.createLink(where(path), where(draft))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                context.rename(self._path(draft), self._path(path), options)
            return True
        except Exception:
            if fs.exists(self._path(path)):
                return False
            raise
        finally:
            fs.delete(self._path(draft), False)

    # -- versions -----------------------------------------------------------
    def versions(self, table: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self._dir(table)}/{VERSIONS}") if n.endswith(".json") and n[:-5].isdigit())

    def current_version(self, table: str) -> int | None:
        return max(self.versions(table), default=None)

    def manifest(self, table: str, version: int | None = None) -> dict | None:
        version = self.current_version(table) if version is None else version
        if version is None:
            return None
        at = (table, version)
        if at not in self._manifests:
            stream = self._fs().open(self._path(f"{self._dir(table)}/{VERSIONS}/{version}.json"))
            try:
                self._manifests[at] = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
        return self._manifests[at]

    def publish(self, table: str, base: int | None, parts: dict, rows: int, started: float | None = None, **more) -> int:
        """Make ``parts`` the version after ``base``, or raise `StaleBase`."""
        version = (base or 0) + 1
        self._fs().mkdirs(self._path(f"{self._dir(table)}/{VERSIONS}"))
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        text = json.dumps({"version": version, "parts": parts, "row_count": rows, "committed_at": now.isoformat(timespec="milliseconds"),
                           "duration_ms": int((time.time() - started) * 1000) if started else None, **more}, ensure_ascii=False)
        current = self.current_version(table)
        if current != base or not self._create(f"{self._dir(table)}/{VERSIONS}/{version}.json", text):
            raise StaleBase(f"{table}: merged from version {base}, the current one is {self.current_version(table)}")
        return version

    def clone(self, table: str, into: MirrorStore, name: str | None = None) -> int:
        """The current version as the next one of a table in another store, over
        the same files: neither side's later versions touch the other's.  The
        source must keep the files (its prune does not know of the clone)."""
        found = self.manifest(table)
        parts = {p: {**s, "generations": [self._generation(table, p, g) for g in s["generations"]]} for p, s in found["parts"].items()}
        return into.publish(name or table, into.current_version(name or table), parts, found["row_count"])

    def _generation(self, table: str, part: str, name: str) -> str:
        """The folder of a generation; a clone names its source's by their paths."""
        return name if "/" in name else f"{self._dir(table)}/{part}/{name}"

    # -- reading --------------------------------------------------------------
    def read(self, table: str, schema=None, version: int | None = None, part: str = ROWS, buckets: list[int] | None = None,
             number: bool = False) -> DataFrame | None:
        """A version's rows (the current one's); with ``buckets`` only theirs, whose
        files alone are read, with ``number`` the bucket as column `BUCKET`.  A
        keyed part is a bucketed table, so joins and aggregations on its key need
        no exchange on this side."""
        found = self.manifest(table, version)
        spec = found["parts"].get(part) if found else None
        if spec is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        names = [F.col(f"c{c['id']}").alias(c["name"]) for c in spec["columns"]]
        ddl = ", ".join(c["ddl"] for c in spec["columns"])
        base = f"{self._dir(table)}/{part}"
        if not spec["buckets"]:
            return self.spark.read.schema(ddl).parquet(*[self._generation(table, part, g) for g in spec["generations"]]).select(*names)
        stamp = hashlib.sha1(f"{base}:{found['version']}".encode()).hexdigest()[:16]
        name = f"mirrorsmith_{stamp}"
        if not self.spark.catalog.tableExists(name):
            keys = ", ".join(quoted(f"c{c['id']}") for k in spec["key"] or [] for c in spec["columns"] if c["name"] == k)
            clustered = f"CLUSTERED BY ({keys}) INTO {int(spec['buckets'])} BUCKETS " if keys else ""
            self.spark.sql(f"CREATE TABLE {name} ({ddl}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                           f"{clustered}LOCATION {_text(f'{base}/{stamp}.none')}")
            have = [(b, self._generation(table, part, spec["generations"][g])) for b, g in enumerate(spec["at"]) if g is not None]
            for i in range(0, len(have), 1000):
                self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
                    f"PARTITION ({BUCKET}={b}) LOCATION {_text(f'{g}/{BUCKET}={b}')}" for b, g in have[i:i + 1000]))
        df = self.spark.table(name)
        if buckets is not None:
            df = df.filter(F.col(BUCKET).isin([int(b) for b in buckets]))
        return df.select(*names, *([BUCKET] if number else []))

    def buckets(self, table: str, part: str = ROWS) -> int:
        found = self.manifest(table)
        return found["parts"][part]["buckets"] if found and part in found["parts"] else 0

    # -- writing --------------------------------------------------------------
    def new_buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _columns(self, df: DataFrame, before: dict | None) -> tuple[list[dict], int]:
        """Columns with their numbers: known ones of the same type keep theirs."""
        known = {(c["name"], c["ddl"].split(" ", 1)[1]): c["id"] for c in before["columns"]} if before else {}
        fresh = before["next"] if before else 1
        out = []
        schema = df._jdf.schema()
        for i, name in enumerate(df.columns):
            # the column's type as DDL, without its name
            kind = schema.apply(i).dataType().sql()
            at = known.get((name, kind))
            if at is None:
                at, fresh = fresh, fresh + 1
            out.append({"id": at, "name": name, "ddl": f"c{at} {kind}"})
        return out, fresh

    def write_part(self, table: str, part: str, df: DataFrame, key: list[str] | None, before: dict | None = None, touched: list[int] | None = None,
                   buckets: int | None = None) -> dict:
        """Write a part's rows as a new generation; its new manifest entry.

        With ``touched``, ``df`` holds the rows of these buckets only; the
        others stay where ``before`` has them.
        """
        columns, fresh = self._columns(df, before)
        generation = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:12]}"
        path = f"{self._dir(table)}/{part}/{generation}"
        out = df.select(*[F.col(quoted(c["name"])).alias(f"c{c['id']}") for c in columns])
        if not key:
            with writing(self.spark):
                out.write.mode("errorifexists").parquet(path)
            return {"columns": columns, "next": fresh, "key": None, "buckets": 0, "generations": [generation], "at": []}
        n = before["buckets"] if before and touched is not None else buckets or self.new_buckets()
        keys = [f"c{c['id']}" for k in key for c in columns if c["name"] == k]
        name = f"mirrorsmith_w_{uuid.uuid4().hex[:16]}"
        # Rows come hash-partitioned by the key out of the merge: a bucket is in one task
        with writing(self.spark):
            out.withColumn(BUCKET, bucket_of(keys, n)).write.partitionBy(BUCKET).bucketBy(n, *keys) \
                .option("path", path).option("compression", "zstd").mode("errorifexists").saveAsTable(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")      # external: the files stay
        return {"columns": columns, "next": fresh, "key": key, "buckets": n, **self._placed(path, generation, n, before, touched)}

    def _placed(self, path: str, generation: str, n: int, before: dict | None, touched: list[int] | None) -> dict:
        """Which generation holds each bucket, after one has been written."""
        written = {int(x.split("=")[1]) for x in self._names(path) if x.startswith(f"{BUCKET}=")}
        if touched is None:
            return {"generations": [generation], "at": [0 if b in written else None for b in range(n)]}
        at = [before["generations"][g] if g is not None else None for g in before["at"]]
        for b in touched:
            at[b] = generation if b in written else None
        used = sorted({g for g in at if g is not None})
        place = {g: i for i, g in enumerate(used)}
        return {"generations": used, "at": [None if g is None else place[g] for g in at]}

    # -- value indexes ----------------------------------------------------------
    def create_index(self, table: str, section: str, field: str) -> int:
        """Keep, for each bucket, the distinct values of a field of a section's
        lines (OP-26): a search reads only buckets that hold what it wants.
        Later versions renew the index of the buckets they write."""
        found = self.manifest(table)
        part = "values-" + hashlib.sha1(f"{section}.{field}".encode()).hexdigest()[:12]
        spec = self._write_index(table, part, {"section": section, "field": field}, found["parts"][ROWS], None, None)
        return self.publish(table, found["version"], {**found["parts"], part: spec}, found["row_count"], batches=found.get("batches", {}))

    def _write_index(self, table: str, part: str, of: dict, rows: dict, before: dict | None, touched: list[int] | None) -> dict:
        line = next(c for c in rows["columns"] if c["name"] == of["section"])
        some = None if touched is None else set(touched)
        files = [(b, rows["generations"][g]) for b, g in enumerate(rows["at"]) if g is not None and (some is None or b in some)]
        generation = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:12]}"
        path = f"{self._dir(table)}/{part}/{generation}"
        kind = None
        for g in sorted({g for _, g in files}):   # the buckets of one generation at a time
            folder = self._generation(table, ROWS, g)
            held = self.spark.read.schema(f"{line['ddl']}, {BUCKET} INT").option("basePath", folder) \
                .parquet(*[f"{folder}/{BUCKET}={b}" for b, x in files if x == g])
            values = held.select(BUCKET, F.explode(F.col(f"c{line['id']}").getField(of["field"])).alias("c1")).filter("c1 IS NOT NULL").distinct()
            kind = kind or values._jdf.schema().apply(1).dataType().sql()
            values.write.partitionBy(BUCKET).mode("append").parquet(path)
        if not files:
            self._fs().mkdirs(self._path(path))
        kind = kind or (before["columns"][0]["ddl"].split(" ", 1)[1] if before else "STRING")
        return {"columns": [{"id": 1, "name": "value", "ddl": f"c1 {kind}"}], "next": 2, "key": None, "buckets": rows["buckets"], "of": of,
                **self._placed(path, generation, rows["buckets"], before, touched)}

    def renewed(self, table: str, before: dict, parts: dict, touched: list[int] | None) -> dict:
        """``parts`` with the value indexes of ``before`` renewed for the buckets
        written (all without ``touched``); one whose field is gone is left out."""
        out = dict(parts)
        for name, spec in before["parts"].items():
            if "of" in spec:
                out.pop(name, None)
                column = next((c for c in parts[ROWS]["columns"] if c["name"] == spec["of"]["section"]), None)
                if column is not None and quoted(spec["of"]["field"]).strip("`") in column["ddl"]:
                    out[name] = self._write_index(table, name, spec["of"], parts[ROWS], spec, touched)
        return out

    def buckets_with(self, table: str, section: str, field: str, wanted: list) -> list[int] | None:
        """Buckets whose lines hold all ``wanted`` values; None without an index.
        At most as many numbers as there are buckets reach the driver."""
        found = self.manifest(table)
        part = next((p for p, s in found["parts"].items() if s.get("of") == {"section": section, "field": field}), None)
        if part is None:
            return None
        hits = self.read(table, part=part, number=True).filter(F.col("value").isin(wanted))
        return sorted(r[0] for r in hits.groupBy(BUCKET).agg(F.count_distinct("value").alias("n")).filter(F.col("n") == len(set(wanted))).select(BUCKET).collect())

    def commit(self, table: str, df: DataFrame, started: float | None = None, bucket_key: list[str] | None = None,
               base: int | None = None, keep_parts: tuple[str, ...] = (ANSWERS,)) -> tuple[int, int]:
        """Write ``df`` as the whole next version; returns (version, row count).

        ``base`` is the version that ``df`` was merged from: if another writer
        has committed since, nothing is committed and `StaleBase` is raised.
        Without a base the version comes after whichever is current.  Parts of
        ``keep_parts`` stay as they are.
        """
        found = self.manifest(table, base) if base is not None else self.manifest(table)
        parts = {p: s for p, s in found["parts"].items() if p in keep_parts} if found else {}
        parts[ROWS] = self.write_part(table, ROWS, df, bucket_key, found["parts"].get(ROWS) if found else None)
        if found and bucket_key:
            parts = self.renewed(table, found, parts, None)
        rows = self._count(table, parts[ROWS])
        while True:
            after = found["version"] if found else None
            try:
                return self.publish(table, after, parts, rows, started, batches=found.get("batches", {}) if found else {}), rows
            except StaleBase:
                if base is not None:
                    raise
                found = self.manifest(table)

    def _count(self, table: str, spec: dict) -> int:
        """Rows of a part just written, from the files' footers."""
        return self.spark.read.schema(spec["columns"][0]["ddl"]).parquet(*[self._generation(table, ROWS, g) for g in spec["generations"]]).count()

    def alter(self, table: str, drop: list[str] = (), rename: dict[str, str] | None = None) -> int:
        """Drop or rename columns of the rows: a new manifest over the same files."""
        found = self.manifest(table)
        spec = dict(found["parts"][ROWS])
        gone = set(drop)
        if gone & set(spec["key"] or []):
            raise ValueError("a key column cannot be dropped")
        rename = rename or {}
        spec["columns"] = [{**c, "name": rename.get(c["name"], c["name"])} for c in spec["columns"] if c["name"] not in gone]
        spec["key"] = [rename.get(k, k) for k in spec["key"]] if spec["key"] else spec["key"]
        parts = {p: s for p, s in found["parts"].items() if "of" not in s or s["of"]["section"] not in gone | set(rename)}
        return self.publish(table, found["version"], {**parts, ROWS: spec}, found["row_count"], batches=found.get("batches", {}))

    def prune(self, table: str, keep: int | None = None) -> list[int]:
        """Delete all but the last ``keep`` versions, and the files that only
        they name; returns the versions deleted.  A reader of an older version
        loses it, so keep as many as the longest reader needs.  Files that no
        manifest names (a write that died, or one under way) go after a day."""
        fs = self._fs()
        all_versions = self.versions(table)
        old = all_versions[:-(keep or self.keep)]
        if not old:
            return []
        kept = [self.manifest(table, v) for v in all_versions[len(old):]]
        gone = [self.manifest(table, v) for v in old]
        used = {(p, g) for m in kept for p, s in m["parts"].items() for g in s["generations"]}
        named = {(p, g) for m in gone for p, s in m["parts"].items() for g in s["generations"]}
        for m in gone:  # the manifest first: what it names is then no version's
            fs.delete(self._path(f"{self._dir(table)}/{VERSIONS}/{m['version']}.json"), False)
            self._manifests.pop((table, m["version"]), None)
            for p in m["parts"]:
                stamp = hashlib.sha1(f"{self._dir(table)}/{p}:{m['version']}".encode()).hexdigest()[:16]
                self.spark.sql(f"DROP TABLE IF EXISTS mirrorsmith_{stamp}")
        old_ms = int((time.time() - ABANDONED_S) * 1000)
        for p in {p for p, _ in used | named}:
            abandoned = {(p, g) for g in self._names(f"{self._dir(table)}/{p}") if g[:13].isdigit() and int(g[:13]) < old_ms}
            for _, g in ({x for x in named if x[0] == p and "/" not in x[1]} | abandoned) - used:   # a clone's source keeps its own
                fs.delete(self._path(f"{self._dir(table)}/{p}/{g}"), True)
        return old

    # -- views ------------------------------------------------------------------
    def register(self, table: str, desc: TableDescription | None = None) -> None:
        """Temp views over the current version: the table by its full name
        (kind and object), by its short one if it has one, and one detail view
        per section."""
        df = self.read(table, desc.spark_schema() if desc else None)
        df.createOrReplaceTempView(quoted(table))
        if desc:
            kind = table.split(".", 1)[0]
            if desc.view and f"{kind}.{desc.view}" != table:
                df.createOrReplaceTempView(quoted(f"{kind}.{desc.view}"))
            for col, sec in desc.sections.items():
                detail = df.select(F.explode_outer(col).alias("_l")).filter(F.col("_l").isNotNull()).select("_l.*")
                detail.createOrReplaceTempView(quoted(f"{kind}.{sec.view}"))
