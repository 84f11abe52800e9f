"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; the high bits of the hash choose one of the
bins, the rest is its value, and a bin keeps its least value.  Empty bins copy
a full bin that a hash of (bin, attempt) finds ("optimal" densification: the
tries do not depend on the document, so equal bins of two documents are equal
with the probability that their similarity gives).  The low bits of the bins,
packed, are the fingerprint; the share of equal bins, less those that agree by
chance, is the likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import shuffle_partitions
from mirrorsmith.llm.text import byte_values, chunks, hash_ranges, mix64, seeds, shingles, word_ranges

BINS, BITS, WORDS = 256, 4, 5
SLICE = 4 << 20      # characters of text handled at once
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def densified(bins: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row (a row with a full bin at least)."""
    row, col = np.nonzero(bins == _NONE)
    full = bins != _NONE
    out = bins.copy()
    key = mix64(seeds(BINS, 31))
    attempt = 0
    while len(row):
        attempt += 1
        pick = (mix64(key[col] + np.uint64(attempt)) >> np.uint64(40)).astype(np.int64) % BINS
        ok = full[row, pick]
        out[row[ok], col[ok]] = bins[row[ok], pick[ok]]
        row, col = row[~ok], col[~ok]
    return out


def bin_values(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of the bins of each text (uint8, one a bin), and whether it has words."""
    values, per_bin = byte_values(1, lower=False), seeds(BINS, 32)
    low, some = [], []
    for _, _, buf, off in chunks(pa.array(texts, pa.large_string())):
        starts, ends, row = word_ranges(buf, off)
        s, at = shingles(hash_ranges(buf, starts, ends, values), row, words)
        n = len(off) - 1
        bins = np.full((n, BINS), _NONE, np.uint64)
        doc = np.repeat(np.arange(n), np.diff(at))
        np.minimum.at(bins.reshape(-1), doc * BINS + (s >> np.uint64(56)).astype(np.int64), s & np.uint64((1 << 56) - 1))
        has = np.diff(at) > 0
        bins[has] = densified(bins[has])
        # A copied value takes other low bits in each bin, so that bins agree by chance independently.
        low.append((mix64(bins + per_bin) & np.uint64((1 << BITS) - 1)).astype(np.uint8))
        some.append(has)
    return (np.concatenate(low), np.concatenate(some)) if low else (np.zeros((0, BINS), np.uint8), np.zeros(0, bool))


def packed(low: np.ndarray, some: np.ndarray) -> list[str]:
    """Fingerprints in hexadecimal; a text without words has the empty one."""
    two = low[:, ::2] << BITS | low[:, 1::2]
    return [x.tobytes().hex() if has else "" for x, has in zip(two, some)]


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated similarity, 0 to 1, corrected for bins that agree by chance.

    Two texts without words are alike (1), one with and one without are not (0).
    """
    chance = 1 / (1 << BITS)
    j = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(a_some & b_some, j, (a_some == b_some).astype(float))


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by the start of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted stream (range, guest, doc_id, text); each row's next is
    the row after it in its range, and a guest only serves as a next."""
    held: list[tuple] = []

    def done(rows: list[tuple]) -> pa.RecordBatch | None:
        texts = [r[3] or "" for r in rows]
        low, some = bin_values(texts)
        mine = [i for i, r in enumerate(rows[:-1]) if not r[1] and rows[i + 1][0] == r[0]]
        if not mine:
            return None
        new = [edited(texts[i], texts[i + 1]) for i in mine]
        e_low, e_some = bin_values(new)
        at = np.array(mine)
        cols = [[rows[i][2] for i in mine], [len(texts[i]) for i in mine], [hashlib.sha256(t.encode()).hexdigest() for t in new],
                packed(low[at], some[at]), packed(e_low, e_some),
                likeness(low[at], some[at], e_low, e_some), likeness(low[at], some[at], low[at + 1], some[at + 1])]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    size = 0
    for b in batches:
        for r in zip(*[c.to_pylist() for c in b.columns]):
            held.append(r)
            size += len(r[3] or "")
            if size > SLICE or len(held) > 4096:
                if (out := done(held)) is not None:
                    yield out
                held, size = held[-1:], len(r[3] or "")
    if held and (out := done(held)) is not None:
        yield out


def placer(tops: list[tuple[int, int]]):
    """Twice the range of each (d, m), plus one for the first row of a range.

    ``tops`` are the first rows of the ranges; ranges and rows are in falling order.
    """
    rising = sorted(tops)
    of_d, of_m = (np.array([t[i] for t in rising], np.int64) for i in (0, 1))

    @F.pandas_udf("long")
    def place(d: pd.Series, m: pd.Series) -> pd.Series:
        d, m = d.to_numpy(), m.to_numpy()
        below, to = np.searchsorted(of_d, d, "left"), np.searchsorted(of_d, d, "right")
        for x in np.unique(d[to > below]):   # ids that are first in some range: the text's hash decides
            lo, hi = np.searchsorted(of_d, x, "left"), np.searchsorted(of_d, x, "right")
            mine = d == x
            below[mine] = lo + np.searchsorted(of_m[lo:hi], m[mine], "left")
        at = np.minimum(below, len(of_d) - 1)
        first = (of_d[at] == d) & (of_m[at] == m)
        return pd.Series(2 * (len(of_d) - 1 - at) + first)

    return place


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edit with the next document.

    Next is the next smaller doc_id, after the smallest the largest; a null
    doc_id comes after all, rows that share a doc_id follow in the order of
    their text's hash.  A null text is empty.  A single document is its own
    next.  Other columns are ignored.

    Ids and hashes of texts are range-partitioned first, which gives the first
    row of each range: two numbers a partition reach the driver.  Then texts are
    dealt to those ranges, one a partition, and the first row of each range to
    the range before it as well, so that every row finds its next in its own.
    Rows that share an id, or have none, spread by their texts.
    """
    parts = shuffle_partitions(docs.sparkSession)
    low = F.lit(-(1 << 63))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .select(F.coalesce("doc_id", low).alias("d"), "doc_id", "text", F.xxhash64("text").alias("m"))
    keys = rows.select("d", "m").repartitionByRange(parts, F.col("d").desc(), F.col("m").desc())
    tops = [(r["top"]["d"], r["top"]["m"]) for r in keys.groupBy(F.spark_partition_id().alias("r")).agg(F.max(F.struct("d", "m")).alias("top")).collect()]
    if not tops:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    last = len(tops) - 1
    own = (F.col("at") / 2).cast("int")
    before = F.when(own == 0, last).otherwise(own - 1)
    place = lambda r, guest: F.struct(r.cast("int").alias("range"), F.lit(guest).alias("guest"))
    sent = rows.withColumn("at", placer(tops)("d", "m")) \
        .withColumn("to", F.explode(F.when(F.col("at") % 2 == 1, F.array(place(own, False), place(before, True))).otherwise(F.array(place(own, False))))) \
        .select("to.range", "to.guest", "doc_id", "text", "d", "m")
    order = [F.col("range"), F.col("guest"), F.col("d").desc(), F.col("m").desc()]
    return sent.repartitionById(parts, F.col("range")).sortWithinPartitions(*order).select("range", "guest", "doc_id", "text").mapInArrow(_paired, SCHEMA)
