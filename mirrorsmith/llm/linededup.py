"""Line dedup: a line that several documents hold stays in the first of them.

Keys of lines (128-bit hashes) are range-partitioned with a secondary sort by
document and position, and streamed: a run of equal keys starts with the
document that keeps the line.  A key that fills whole ranges (a third of all
lines may share it) is one run per range; the first document of such runs, two
rows per range at most, settles them.  The result is a compressed bitmap of
kept lines for each document that loses any, not text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import renamed, shuffle_partitions, stored
from mirrorsmith.llm.text import byte_values, chunks, hash_ranges, word_ranges

MIN_CHARS = 10
_LAST = (1 << 63) - 1   # a row without a doc_id comes after all others


def keyed_lines(min_chars: int):
    """Per line with a long enough key: the key's hashes, document, position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_values(21, lower=True), byte_values(22, lower=True)
        for b in batches:
            doc, mark = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for first, last, buf, off in chunks(b.column(2)):
                starts, ends, _ = word_ranges(buf, off)
                if not len(starts):
                    continue
                # A line starts at a text's first byte or after a \n.
                breaks = np.flatnonzero(buf == 10) + 1
                begin = np.unique(np.concatenate([off[:-1], breaks]))
                begin = begin[begin < len(buf)]
                row = np.searchsorted(off, begin, "right") - 1
                stop = np.append(begin[1:], len(buf))
                a, z = np.searchsorted(starts, begin), np.searchsorted(starts, stop) - 1
                pos = np.searchsorted(breaks, begin, "right") - np.searchsorted(breaks, off[row], "right")
                full = z >= a
                s, e = starts[a[full]], ends[z[full]]
                chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                long = chars[e] - chars[s] >= min_chars
                s, e = s[long], e[long]
                row, pos = first + row[full][long], pos[full][long]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (hash_ranges(buf, s, e, one).astype(np.int64), hash_ranges(buf, s, e, two).astype(np.int64),
                                           doc[row], mark[row], pos.astype(np.int32))], names=["h1", "h2", "doc", "mark", "pos"])
    return run


def first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a sorted range that are not their run's first document (kind 0),
    all lines of the range's first run (kind 1), and the first document of its
    first and last run (kind 2)."""
    key = head = tail = None  # the current run's key; first documents of the first and of the last run
    for b in batches:
        h1, h2, doc, mark, pos = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        if not len(h1):
            continue
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = key is None or key != (h1[0], h2[0])
        start = np.flatnonzero(new)
        run = np.cumsum(new)
        owner = np.concatenate([[tail[2] if tail else 0], doc[start]])[run]
        in_head = np.zeros(len(h1), bool)
        if head is None:
            head = (h1[0], h2[0], doc[0])
        if (h1[0], h2[0]) == head[:2]:
            in_head = run == run[0]
        key, tail = (h1[-1], h2[-1]), (h1[-1], h2[-1], owner[-1])
        out = in_head | (doc != owner)
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (h1, h2, doc, mark, pos, owner, in_head.astype(np.int32))],
                                         names=["h1", "h2", "doc", "mark", "pos", "owner", "kind"])
    if head:
        ends = list(zip(head, tail))
        z = [0, 0]
        cols = [ends[0], ends[1], ends[2], z, z, ends[2], [2, 2]]
        types = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], t) for c, t in zip(cols, types)],
                                         names=["h1", "h2", "doc", "mark", "pos", "owner", "kind"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        maps = []
        for p in b.column(2).to_pylist():
            keep = np.ones((max(p) // 8 + 1) * 8, np.uint8)
            keep[p] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        n = pa.array([len(p) for p in b.column(2).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n, pa.array(maps, pa.binary())], names=["doc", "mark", "n_dropped", "keep"])


def _marked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A document and, to tell rows that share a doc_id apart, its text's hash."""
    return docs.withColumns({"_doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)), "_mark": F.xxhash64(text)})


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document that loses lines: doc, mark (hash of its text), n_dropped, keep.

    ``keep`` is zlib-compressed; its bits are the lines from the first on, 1
    for kept; lines beyond it are kept.  ``docs`` needs doc_id and text.  Lines
    end at \\n.  A key is the line without white space at its ends, A-Z lower-
    cased; shorter keys than ``min_chars`` code points are never dropped.  A
    null or empty text is one empty line.  Rows that share a doc_id are one
    document; rows without a doc_id are one that comes last.
    """
    lines = _marked(docs.select("doc_id", "text")).select("_doc", "_mark", "text") \
        .mapInArrow(keyed_lines(min_chars), "h1 long, h2 long, doc long, mark long, pos int")
    order = ["h1", "h2", "doc", "pos"]
    found = stored(lines.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
                   .mapInArrow(first_occurrences, "h1 long, h2 long, doc long, mark long, pos int, owner long, kind int"), "lines")
    # Two rows per range at most, whatever the input.
    ends = found.filter("kind = 2").groupBy("h1", "h2").agg(F.min("owner").alias("first"))
    dropped = found.filter("kind < 2").join(F.broadcast(ends), ["h1", "h2"], "left").filter(F.col("doc") > F.coalesce("first", "owner"))
    return dropped.groupBy("doc", "mark").agg(F.collect_set("pos").alias("pos")).mapInArrow(_bitmaps, "doc long, mark long, n_dropped long, keep binary")


def _kept(text: str | None, keep: bytes | None) -> tuple[int, str]:
    lines = (text or "").split("\n")
    if keep is None:
        return len(lines), text or ""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    return len(lines), "\n".join(x for i, x in enumerate(lines) if i >= len(bits) or bits[i])


def _with_bitmaps(marked: DataFrame, maps: DataFrame) -> DataFrame:
    """Adds _keep and _dropped (null where nothing goes)."""
    maps = maps.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), F.col("n_dropped").alias("_dropped"), F.col("keep").alias("_keep"))
    return marked.join(maps.hint("shuffle_hash"), ["_doc", "_mark"], "left")


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [_kept(t.as_py(), k.as_py()) for t, k in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in kept], pa.int64()), b.column(3),
                                              pa.array([hashlib.sha256(t.encode()).hexdigest() for _, t in kept], pa.string())],
                                             names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return _with_bitmaps(_marked(docs.select("doc_id", "text")), keep_bitmaps(docs)).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "_keep", F.coalesce("_dropped", F.lit(0)).cast("long").alias("_dropped")) \
        .mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the kept lines as text; a null text stays null."""
    rows, name = renamed(docs)
    names, at = list(name.values()), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(at)
            texts = [t if k is None else _kept(t, k)[1] for t, k in zip(old.to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            cols = list(b.columns)[:-1]
            cols[at] = pa.array(texts, old.type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return _with_bitmaps(_marked(rows, name["doc_id"], name["text"]), keep_bitmaps(docs, min_chars)) \
        .select(*names, "_keep").mapInArrow(run, rows.schema).toDF(*docs.columns)


ORACLE = r"""
WITH l AS (
  SELECT doc_id, UNNEST(string_split(COALESCE(text, ''), chr(10))) AS line, generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, MIN(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING COUNT(DISTINCT doc_id) > 1),
j AS (SELECT k.*, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, COUNT(*) AS n_lines, CAST(SUM(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
