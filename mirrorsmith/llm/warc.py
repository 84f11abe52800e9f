"""Content-addressed WARC archive.

``write_archive`` stores two tables in the shared folder: ``payloads``, each
distinct payload once under its SHA-256, compressed; and ``records``, the exact
WARC and HTTP header bytes of every record with the address of its payload.
``read_records`` joins them back, checks every payload against its address,
its length and the digest in the record's own header, and can emit the whole
record bytes.  A task handles one record at a time; equal payloads are merged
inside each task before they are shuffled, so a payload that a third of all
records share costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorsmith.llm.common import scratch_path, stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_FROM = 0                  # payload bytes from which an equal payload becomes a revisit
DATE = "1970-01-01T00:00:00Z"     # the pages carry no date of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal SHA-1: 5 digits are 20 bits, 4 letters."""
    def letters(i: Column) -> Column:
        bits = F.conv(F.substr(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def record_id(page_id: Column, record_no: Column) -> Column:
    """A URN that is the same in every run for a page with an id."""
    h = F.md5(F.concat_ws(":", F.lit("page"), F.coalesce(page_id.cast("string"), F.concat(F.lit("row"), record_no.cast("string")))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([z.compress(x) for x in b.column(1).to_pylist()], pa.binary())], names=["address", "body"])


def write_archive(pages: DataFrame, revisit_from: int = REVISIT_FROM, path: str | None = None) -> str:
    """Write ``pages`` (page_id, url, html) as an archive and return its path.

    The payload is the html in UTF-8; null is empty.  Of records with equal
    payloads of at least ``revisit_from`` bytes, the one with the largest
    page_id is the response and the others revisit it; of rows that repeat the
    largest page_id, the last read is the response.  A null page_id is smaller
    than any other.  Other columns are ignored.  An empty table gives an empty
    archive.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archive")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    facts = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("p"))
                   .select("page_id", "url", F.octet_length("p").cast("long").alias("bytes"), F.unhex(F.sha2("p", 256)).alias("address"), F.unhex(F.sha1("p")).alias("sha1"),
                           F.monotonically_increasing_id().alias("record_no")), "warc-facts")
    first = facts.groupBy("address").agg(F.max(F.struct("page_id", "record_no", "url")).alias("of"))
    revisit = (F.col("bytes") >= revisit_from) & (F.col("record_no") != F.col("of.record_no"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    records = facts.join(first, "address").withColumn("revisit", revisit).withColumn("http", http).select(
        "page_id", F.when(F.col("revisit"), F.col("of.page_id")).alias("refers_to"), "address",
        F.concat(F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
                 line("WARC-Record-ID", record_id(F.col("page_id"), F.col("record_no"))), line("WARC-Date", F.lit(DATE)),
                 line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")),
                 line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.hex("sha1")))),
                 F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", record_id(F.col("of.page_id"), F.col("of.record_no"))), line("WARC-Profile", F.lit(PROFILE))))
                 .otherwise(F.lit("")),
                 F.lit("Content-Type: application/http; msgtype=response\r\n"), line("Content-Length", block.cast("string")), F.lit("\r\n"))
        .cast("binary").alias("warc_header"), F.col("http").cast("binary").alias("http_header"))
    bodies = pages.select(payload.alias("p")).select(F.unhex(F.sha2("p", 256)).alias("address"), "p") \
        .mapInArrow(_compressed, "address binary, body binary")
    bodies.groupBy("address").agg(F.first("body").alias("body")).write.parquet(f"{path}/payloads")
    records.write.parquet(f"{path}/records")
    return path


def _restored(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib

        import zstandard

        z = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for page, refers, address, warc, http, body in zip(*[c.to_pylist() for c in b.columns]):
                if body is None:
                    raise ValueError(f"the payload of the record of page {page} is missing")
                payload = z.decompress(body)
                fields = dict(x.split(": ", 1) for x in warc.decode().split("\r\n")[1:] if x)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                kind = fields["WARC-Type"]
                length = len(http) + (len(payload) if kind == "response" else 0)
                if hashlib.sha256(payload).digest() != address or fields["WARC-Payload-Digest"] != f"sha1:{digest}" or int(fields["Content-Length"]) != length:
                    raise ValueError(f"record of page {page} does not match its payload")
                record = warc + http + (payload if kind == "response" else b"") + b"\r\n\r\n" if whole else b""
                if whole and len(record) != len(warc) + length + 4:
                    raise ValueError(f"the record of page {page} has not the length it states")
                rows.append((page, len(payload), digest, kind, refers, *([record] if whole else [])))
            cols = list(zip(*rows)) or [[]] * (5 + whole)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record"][:5 + whole])
    return run


def read_records(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """The records of an archive, verified; with ``whole``, their full bytes.

    A record whose payload is missing, or does not have the digest and length
    that the record states, stops the job."""
    records = spark.read.schema("page_id long, refers_to long, address binary, warc_header binary, http_header binary").parquet(f"{path}/records")
    payloads = spark.read.schema("address binary, body binary").parquet(f"{path}/payloads")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return records.join(payloads, "address", "left").select("page_id", "refers_to", "address", "warc_header", "http_header", "body") \
        .mapInArrow(_restored(whole), schema + (", record binary" if whole else ""))


ORACLE = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS address, sha1(h) AS x FROM p),
m AS (SELECT *, MAX(page_id) OVER (PARTITION BY address) AS top FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m
"""
