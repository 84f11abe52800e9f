"""Keyed refresh driven by a stream of landed key responses (OP-34).

The per-key refresh of the studied system (fetch one key inside a query,
upsert or delete it) becomes a Structured Streaming query: responses to key
requests land as JSON lines ``{"keys": {<key fields>}, "value": [rows],
"seq": <n>}`` in a folder; each micro-batch is applied as one batch refresh:
the last response of each requested key counts, one with a row upserts it, one
with an empty ``value`` deletes it, other rows stay.  ``seq`` orders the
responses, also across batches: the last one of each key is kept beside the
mirror, so a later batch cannot bring an older state back.  Responses without it
count in the order of their batches, of their files' times and names and of
their lines.  A response that cannot be read stops the batch, and so does one
that counts and holds more than one row.

Each micro-batch commits one new version that rewrites the buckets of its keys;
the version names the stream and the batch, so a batch replayed after a failure
is skipped.  The streaming checkpoint must live in a shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from mirrorsmith.functions.decode import FAIL_FAST, decode_row, decode_sections, decode_some, read_schema, number_text
from mirrorsmith.plans.description import TableDescription
from mirrorsmith.plans.refresh import FOUND, SEQ, applied, commit_answers
from mirrorsmith.plans.store import MirrorStore, mirror_root


def response_schema(desc: TableDescription) -> T.StructType:
    row = read_schema(desc)
    key_fields = [f for f in row.fields if f.name in {c.name_src for c in desc.columns if c.name in desc.key}]
    return T.StructType([T.StructField("keys", T.StructType(key_fields)),
                         T.StructField("value", T.ArrayType(row)),
                         T.StructField("seq", T.LongType())])


def answers_of(batch: DataFrame, desc: TableDescription) -> DataFrame:
    """The last answer of each key in a batch of responses (``value`` text lines,
    optionally with their file's ``file_time`` and ``file_name``), as
    `commit_answers` takes them: key, found, seq and the other columns.

    A response is parsed once; the last one per key is taken before anything
    is decoded or joined.
    """
    placed = [F.col(c) for c in ("file_time", "file_name") if c in batch.columns]
    schema = response_schema(desc)
    parsed = batch.select(F.from_json(number_text(F.col("value"), schema), schema, FAIL_FAST).alias("r"), *placed, F.monotonically_increasing_id().alias("_line"))
    need = lambda field: F.coalesce(F.col(f"r.{field}"), F.raise_error(F.lit(f"a key response has no {field}"))
                                    .cast(schema[field].dataType))
    fields = parsed.select(need("keys").alias("k"), need("value").alias("v"), F.col("r.seq").alias(SEQ), *placed, "_line")
    keyed = fields.select(*decode_some(F.col("k"), desc, desc.key), "v", SEQ, *placed, "_line")
    order = [F.col(SEQ).desc_nulls_last(), *[c.desc() for c in placed], F.col("_line").desc()]
    last = keyed.withColumn("_n", F.row_number().over(Window.partitionBy(*desc.key).orderBy(*order))).filter("_n = 1")
    return decoded_answers(last, desc, schema["value"].dataType.elementType)


def decoded_answers(rows: DataFrame, desc: TableDescription, element: T.DataType) -> DataFrame:
    """Answers (key, ``v``: its rows, `SEQ`) with the columns of their row; the
    row of a key that is gone is NULL."""
    many = F.raise_error(F.concat(F.lit("a key response has "), F.size("v").cast("string"), F.lit(" rows"))).cast(element)
    one = rows.select(*desc.key, SEQ, F.when(F.size("v") > 1, many).otherwise(F.get("v", F.lit(0))).alias("row"))
    decoded = one.select(F.col("row").isNotNull().alias(FOUND), SEQ, *decode_row(F.col("row"), desc, sections=False, decoded=set(desc.key)))
    fetched = decode_sections(decoded, desc, [FOUND, SEQ])
    return fetched.select(*desc.key, FOUND, SEQ, *[c.name for c in desc.columns if c.name not in desc.key])


def apply_responses(batch: DataFrame, desc: TableDescription, current: DataFrame) -> DataFrame:
    """Rows after one batch of key responses, without storing them: one outer
    join with the stored side (bucketed by the key) replaces, adds and deletes."""
    return applied(current, answers_of(batch, desc), desc.key).select(*[c.name for c in desc.columns])


def apply_batch(store: MirrorStore, desc: TableDescription, batch: DataFrame, table: str | None = None,
                stream: str | None = None, number: int | None = None) -> int | None:
    """Store a batch of key responses; the version, None if nothing was new."""
    table = table or desc.table
    version = commit_answers(store, table, answers_of(batch, desc), desc.key, stream, number)
    if version is not None:
        store.prune(table)
        store.register(table, desc)
    return version


def start(spark: SparkSession, landed_dir: str, desc: TableDescription, store: MirrorStore,
          table: str | None = None, checkpoint: str | None = None, available_now: bool = True):
    """Start the stream; with ``available_now`` it processes what has landed and stops."""
    table = table or desc.table
    checkpoint = checkpoint or mirror_root(spark) + f"/_streams/{table}"

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        apply_batch(store, desc, batch, table, checkpoint, epoch_id)

    stream = spark.readStream.format("text").load(landed_dir).select(
        "value", F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_name").alias("file_name"))
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
