"""Full and keyed refresh, views, control table (OP-06, 07, 10, 54, 55).

A refresh merges a load with the stored version and writes the buckets that
change (`mirrorsmith.plans.store`); a report over a refresh in flight uses the
same merge without writing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from mirrorsmith.functions.decode import decode_row, decode_sections, decode_some, read_schema
from mirrorsmith.operators.dedup import first_arrival
from mirrorsmith.operators.incremental import ROW_COUNT, VALUE_COUNT, maintained, view_delta
from mirrorsmith.operators.sections import contains_all
from mirrorsmith.operators.merge import DELETE, INSERT, SAME, UPDATE, apply_changes, change_set
from mirrorsmith.plans.description import TableDescription
from mirrorsmith.plans.store import ANSWERS, BUCKET, ROWS, MirrorStore, StaleBase, bucket_of, mirror_root, quoted  # noqa: F401
from mirrorsmith.session import checkpoint_dir, writing
from mirrorsmith.sources.pages import check_page_set, read_pages

ACTIONS = (INSERT, UPDATE, DELETE, SAME)
CONTROL_SCHEMA = ("server string, table string, kind string, schema string, name string, fetch_size int, "
                  "row_count long, refresh_data_ts timestamp_ntz, refresh_data_ms long")


def default_fetch_size(work_mem_mb: int = 64) -> int:
    """Rows per page: max(memory MB / 32, 1) × 5000 (10,000 at 64 MB)."""
    return max(work_mem_mb // 32, 1) * 5000


def create_table(store: MirrorStore, desc: TableDescription, table: str | None = None) -> int:
    """Mirror sink (OP-07): an empty first version with the described schema,
    registered as a view with one detail view per section.  Does nothing when
    the table already has a version (like creating an existing table)."""
    table = table or desc.table
    version = store.current_version(table)
    if version is None:
        version, _ = store.commit(table, store.spark.createDataFrame([], desc.spark_schema()))
    store.register(table, desc)
    return version


# --------------------------------------------------------------------------
# Refresh jobs
# --------------------------------------------------------------------------

def load_from_pages(pages: DataFrame, desc: TableDescription) -> DataFrame:
    """Landed pages → decoded, deduplicated load (first arrival wins).

    Only the key columns are decoded before the dedup; the other columns are
    decoded for the winning copy of each key alone.
    """
    rows = read_pages(pages, read_schema(desc))
    names = [c.name for c in desc.columns]
    keyed = rows.select("page_no", "pos", "row", *decode_some(F.col("row"), desc, desc.key))
    # the decoded key columns are carried, not decoded again: the rows stay
    # hash-partitioned by them for the merge join that follows
    winners = first_arrival(keyed, desc.key).select(*desc.key, "row")
    staged = winners.select(*decode_row(F.col("row"), desc, sections=False, decoded=set(desc.key)))
    return decode_sections(staged, desc, []).select(*names)


def refresh_full(current: DataFrame, load: DataFrame, desc: TableDescription) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, change set) of a complete load (OP-06 / OP-30)."""
    changes = change_set(current, load, desc.key, desc.version)
    return apply_changes(changes, desc.key), changes


class Staged:
    """Rows written once under the checkpoint folder in the buckets of a mirror,
    so that steps over them neither repeat the work before nor exchange rows."""

    def __init__(self, spark: SparkSession, rows: DataFrame, key: list[str], buckets: int):
        self.spark, self.key, self.n = spark, key, buckets
        self.name = f"mirrorsmith_s_{uuid.uuid4().hex[:16]}"
        self.columns = rows.columns
        plain = {c: f"c{i}" for i, c in enumerate(rows.columns)}
        out = rows.select(*[F.col(quoted(c)).alias(n) for c, n in plain.items()])
        keys = [plain[k] for k in key]
        path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{self.name}"
        with writing(spark):
            out.withColumn(BUCKET, bucket_of(keys, buckets)).write.partitionBy(BUCKET).bucketBy(buckets, *keys) \
                .option("path", path).option("compression", "zstd").mode("errorifexists").saveAsTable(self.name)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        df = self.spark.table(self.name)
        if buckets is not None:
            df = df.filter(F.col(BUCKET).isin(buckets))
        return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(self.columns)])

    def held(self) -> list[int]:
        """The buckets that hold rows: at most as many as there are."""
        return sorted(r[0] for r in self.spark.table(self.name).select(BUCKET).distinct().collect())

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


ATTEMPTS = 5     # times that a keyed change is merged again after another writer's commit


def commit_changes(store: MirrorStore, table: str, load: DataFrame, key: list[str], version: str | None = None,
                   started: float | None = None, check=None) -> dict:
    """Make the mirror equal to a complete load; write the buckets that change.

    The load is staged once in the mirror's buckets.  A narrow pass (key and
    version, or all columns where there is no version) counts the actions of
    each bucket; only buckets with a change are read, merged and written, the
    others stay where they are.  ``check(changes)`` may raise: nothing is
    published then.  Returns the counts, the row count, the version and how many
    buckets were written.
    """
    base = store.current_version(table)
    before = store.manifest(table)
    spec = before["parts"][ROWS] if before else None
    if spec is None or not spec["buckets"] or spec["key"] != key or [c["name"] for c in spec["columns"]] != load.columns:
        # nothing to merge with in place: the first load, or one after a change of the schema
        current = store.read(table, load.schema)
        same = current if current.schema.names == load.columns else store.spark.createDataFrame([], load.schema)
        changes = change_set(same, load, key, version)
        if check:
            check(changes)
        obs = Observation(f"changes_{uuid.uuid4().hex}")
        counted = changes.observe(obs, *[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS])
        number, rows = store.commit(table, apply_changes(counted, key), started, bucket_key=key, base=base)
        n = store.manifest(table, number)["parts"][ROWS]["at"]
        return {**{a: int(obs.get[a]) for a in ACTIONS}, "version": number, "row_count": rows, "buckets_written": sum(g is not None for g in n)}
    n = spec["buckets"]
    staged = Staged(store.spark, load, key, n)
    try:
        changes = change_set(store.read(table, version=base), staged.read(), key, version)
        if check:
            check(changes)
        counts = changes.filter(F.col("action") != SAME).groupBy(bucket_of(key, n).alias("_b"), "action").agg(F.count(F.lit(1)).alias("n")).collect()
        total = {a: sum(r["n"] for r in counts if r["action"] == a) for a in ACTIONS}
        total[SAME] = before["row_count"] - total[UPDATE] - total[DELETE]
        touched = sorted({r["_b"] for r in counts})
        parts = before["parts"]
        if touched:
            some = None if len(touched) == n else touched
            merged = apply_changes(change_set(store.read(table, version=base, buckets=some), staged.read(some), key, version), key)
            parts = {**parts, ROWS: store.write_part(table, ROWS, merged.select(*load.columns), key, spec, touched)}
            parts = store.renewed(table, before, parts, touched)
        rows = before["row_count"] + total[INSERT] - total[DELETE]
        number = store.publish(table, base, parts, rows, started, batches=before.get("batches", {}))
    finally:
        staged.close()
    return {**total, "version": number, "row_count": rows, "buckets_written": len(touched)}


SEQ, FOUND = "_seq", "_found"


def commit_answers(store: MirrorStore, table: str, answers: DataFrame, key: list[str], stream: str | None = None, batch: int | None = None) -> int | None:
    """Apply key answers (key, `FOUND`, `SEQ` and the other columns; one row a
    key): a found row is upserted, the others' keys are deleted, in the buckets
    of the keys alone.

    The last `SEQ` of each key is kept beside the rows, of deleted keys too: an
    answer that is not later than that is passed over, whenever it arrives.  An
    answer without one counts as the latest.  ``batch`` is the number of a
    stream's batch: one that a version holds already is skipped.  If another
    writer commits first, the answers are merged again onto its version.
    Returns the version, None if there was nothing to do.
    """
    n = store.buckets(table)
    if not n:   # an empty table as it was created: from now on in buckets
        found = store.read(table)
        store.commit(table, found, bucket_key=key, base=store.current_version(table))
        n = store.buckets(table)
    staged = Staged(store.spark, answers, key, n)
    try:
        touched = staged.held()
        for attempt in range(ATTEMPTS):
            base = store.current_version(table)
            before = store.manifest(table, base)
            done = dict(before.get("batches", {}))
            if stream is not None and done.get(stream, -1) >= batch:
                return None
            if not touched:
                return None
            if before["parts"][ROWS]["buckets"] != n:   # rewritten in other buckets meanwhile
                staged.close()
                n = before["parts"][ROWS]["buckets"]
                staged = Staged(store.spark, answers, key, n)
                touched = staged.held()
            try:
                return _apply(store, table, staged, touched, key, before, done | ({stream: batch} if stream is not None else {}))
            except StaleBase:
                if attempt == ATTEMPTS - 1:
                    raise
    finally:
        staged.close()


def _apply(store: MirrorStore, table: str, staged: Staged, touched: list[int], key: list[str], before: dict, batches: dict) -> int:
    spec, last_spec = before["parts"][ROWS], before["parts"].get(ANSWERS)
    answers = staged.read()
    last_schema = answers.select(*key, F.col(SEQ).alias("_last")).schema
    last = store.read(table, last_schema, before["version"], ANSWERS, touched)
    if last_spec and last_spec["buckets"] != spec["buckets"]:
        last = store.read(table, last_schema, before["version"], ANSWERS)
    ruled = answers.join(last, key, "left")
    valid = ruled.filter(F.col("_last").isNull() | F.col(SEQ).isNull() | (F.col(SEQ) > F.col("_last"))).drop("_last")
    current = store.read(table, version=before["version"], buckets=touched)
    merged = applied(current, valid, key)
    counts = current.select(*key, F.lit(True).alias("_had")).join(valid.select(*key, FOUND), key, "full_outer").agg(
        F.count_if(F.col("_had").isNull() & F.col(FOUND)).alias("more"), F.count_if(F.col("_had") & ~F.col(FOUND)).alias("less")).first()
    parts = {**before["parts"], ROWS: store.write_part(table, ROWS, merged.select(*current.columns), key, spec, touched)}
    parts = store.renewed(table, before, parts, touched)
    if answers.filter(F.col(SEQ).isNotNull()).limit(1).count() or last_spec:
        kept = last.join(answers.select(*key, SEQ), key, "full_outer").select(*key, F.greatest("_last", SEQ).alias("_last")).filter("_last IS NOT NULL")
        if last_spec and last_spec["buckets"] == spec["buckets"]:
            parts[ANSWERS] = store.write_part(table, ANSWERS, kept, key, last_spec, touched)
        else:
            parts[ANSWERS] = store.write_part(table, ANSWERS, kept, key, None, None, spec["buckets"])
    return store.publish(table, before["version"], parts, before["row_count"] + counts["more"] - counts["less"], batches=batches)


def applied(current: DataFrame, answers: DataFrame, key: list[str]) -> DataFrame:
    """Rows after key answers: one outer join replaces, adds and deletes."""
    values = [c for c in current.columns if c not in key]
    new = answers.select(*key, FOUND, *[F.col(quoted(c)).alias(f"_new_{c}") for c in values])
    joined = current.join(new, on=key, how="full_outer").filter(F.coalesce(F.col(FOUND), F.lit(True)))
    return joined.select(*[F.col(quoted(c)) if c in key else F.when(F.col(FOUND).isNotNull(), F.col(quoted(f"_new_{c}"))).otherwise(F.col(quoted(c))).alias(c)
                           for c in current.columns])


def containing(store: MirrorStore, table: str, section: str, field: str, wanted: list) -> DataFrame:
    """Rows whose section's lines hold all ``wanted`` values in a field (OP-26).
    With a value index only the buckets that hold them are read."""
    some = store.buckets_with(table, section, field, wanted)
    n = store.buckets(table)
    return store.read(table, buckets=some if some is not None and len(some) < n else None).filter(contains_all(F.col(section).getField(field), wanted))


def lookup(store: MirrorStore, table: str, keys: DataFrame, key: list[str]) -> DataFrame:
    """``keys`` (distinct) with their rows, NULL where there are none (OP-29).

    The buckets of the keys, at most as many as the table has, choose the files
    that are read; both sides then meet by bucket.
    """
    n = store.buckets(table)
    if not n:
        return keys.join(store.read(table), key, "left")
    some = [r[0] for r in keys.select(bucket_of(key, n).alias("_b")).distinct().collect()]
    return keys.join(store.read(table, buckets=some if len(some) < n else None), key, "left")


def refresh_and_commit(store: MirrorStore, desc: TableDescription, pages: DataFrame, table: str | None = None,
                       fetch_size: int | None = None, usual: int | None = None, check=None) -> dict:
    """Full refresh of one table from landed pages, committed as a new version.

    The pages must be one complete read (`check_page_set`): the merge deletes
    what the load lacks, so an incomplete load stops before it.  ``usual`` is
    the table's fetch size where neither the caller nor the pages tell it.
    ``check(changes)`` is `commit_changes`'s.

    Returns the statistics the control table records: row count, start, duration
    and the number of inserted / updated / deleted / unchanged rows; old
    versions are pruned.
    """
    started = time.time()
    table = table or desc.table
    check_page_set(pages, fetch_size, usual or default_fetch_size())
    load = load_from_pages(pages, desc)
    if desc.key:
        stats = commit_changes(store, table, load, desc.key, desc.version, started, check)
    else:   # one row or none: written anew
        version, rows = store.commit(table, load, started, base=store.current_version(table))
        stats = {"version": version, "row_count": rows}
    store.prune(table)
    store.register(table, desc)
    return {**stats, "duration_ms": int((time.time() - started) * 1000)}


# Bumped whenever the stored layout of a snapshot changes.
SNAPSHOT_LAYOUT = 4


def _input_signature(spark: SparkSession, paths: list[str]) -> str:
    """Digest of input paths, sizes and modification times (a changed input
    makes a new snapshot, never a stale read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = [str(SNAPSHOT_LAYOUT)]
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        st = p.getFileSystem(conf).getFileStatus(p)
        parts.append(f"{path}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


_BUILD_LOCKS: dict[str, threading.Lock] = {}
_BUILD_LOCKS_GUARD = threading.Lock()


def _build_lock(path: str) -> threading.Lock:
    """One first-time build per path at a time within this process (queries
    may be submitted from several threads of one session)."""
    with _BUILD_LOCKS_GUARD:
        return _BUILD_LOCKS.setdefault(path, threading.Lock())


def snapshot_root(spark: SparkSession, inputs: list[str]) -> str:
    """Where the mirrors of these inputs are stored."""
    return checkpoint_dir(spark).rstrip("/") + "/mirror/" + _input_signature(spark, inputs)


def ensure_snapshot(spark: SparkSession, table: str, desc: TableDescription, inputs: list[str],
                    pages_fn) -> DataFrame:
    """The stored mirror of ``table`` for these inputs; the first call runs a
    full refresh from ``pages_fn()`` into an empty mirror and commits it."""
    store = MirrorStore(spark, snapshot_root(spark, inputs))
    with _build_lock(store.root + "/" + table):
        if store.current_version(table) is None:
            refresh_and_commit(store, desc, pages_fn(), table)
    return store.read(table)


def landed(spark: SparkSession, name: str, inputs: list[str], pages_fn) -> DataFrame:
    """Source responses landed once per input state in the shared folder
    (``pages_fn()`` builds them on the first call), read back as page rows."""
    from mirrorsmith.sources.pages import read_landed, write_pages
    base = checkpoint_dir(spark).rstrip("/") + "/landed/" + _input_signature(spark, inputs) + "/" + name
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    with _build_lock(base):
        # attempt=<k>: a landing that failed half way is left alone, the next one starts fresh
        attempt = 0
        while True:
            path = f"{base}/attempt={attempt}"
            if fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")):
                break
            if not fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
                # pages are gathered in order, one at a time, not many at once in a hash
                with writing(spark, spark_sql_execution_useObjectHashAggregateExec="false"):
                    write_pages(pages_fn(), path)
                break
            attempt += 1
    return read_landed(spark, path)


def materialize(store: MirrorStore, name: str, df: DataFrame) -> DataFrame:
    """Materialised view (OP-54): write the result as a new version, read it back.
    A refresh is simply another call; readers of the version before are
    untouched, older ones are deleted."""
    store.commit(name, df)
    store.prune(name)
    return store.read(name)


def maintain_view(store: MirrorStore, name: str, changes: DataFrame, group: list, sums: dict) -> DataFrame:
    """A grouped view kept up from a refresh's change set (OP-54): the stored
    groups and the changes are read, the mirror is not (`incremental.maintained`)."""
    base = store.current_version(name)
    view = store.read(name)
    keys = [c for c in view.columns if c != ROW_COUNT and not c.startswith(VALUE_COUNT) and c not in sums]
    store.commit(name, maintained(view, view_delta(changes, group, sums), keys, list(sums)), base=base)
    store.prune(name)
    return store.read(name)


# --------------------------------------------------------------------------
# Control table and refresh selection (OP-10, OP-55)
# --------------------------------------------------------------------------

def select_refresh(control: DataFrame, server: str | None = None, fast: bool = False) -> DataFrame:
    """Tables a bulk refresh visits, in name order: not enumerations; with
    ``fast`` only those smaller than one page (unknown sizes are skipped)."""
    sel = control.filter(F.col("kind") != "Enumeration")
    if server is not None:
        sel = sel.filter(F.col("server") == server)
    if fast:
        sel = sel.filter(F.col("row_count") < F.col("fetch_size"))
    return sel.orderBy("table")


# --------------------------------------------------------------------------
# Audit rows (OP-09)
# --------------------------------------------------------------------------

AUDIT_SCHEMA = ("ts timestamp_ntz, duration_ms long, user string, server string, url string, "
                "fixed boolean, exception string")


def audit_requests(requests: DataFrame, base_url: str, server: str, user: str,
                   started: dt.datetime | None = None, masked: bool = False) -> DataFrame:
    """Request log rows for planned requests (``plan_requests`` output):
    full URL with the password masked, as the request log keeps it.  With
    ``masked`` the base URL holds the mask already: a password may contain
    ``/`` and ``@``, so it is best never put into a URL."""
    from mirrorsmith.functions.literals import mask_credentials
    mask = (lambda c: c) if masked else mask_credentials
    ts = started or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return requests.select(
        F.lit(ts).cast("timestamp_ntz").alias("ts"), F.lit(0).cast("long").alias("duration_ms"),
        F.lit(user).alias("user"), F.lit(server).alias("server"),
        mask(F.concat(F.lit(base_url.rstrip("/")), F.col("url"))).alias("url"),
        F.lit(True).alias("fixed"), F.lit(None).cast("string").alias("exception"))


def append_audit(store: MirrorStore, rows: DataFrame, name: str = "_audit/requests") -> None:
    """Append-only audit table (new files per append, nothing rewritten)."""
    rows.write.mode("append").parquet(f"{store.root}/{name}")
