"""Quality by importance resampling of hashed n-grams.

Two generative models are counted: one over all documents (raw), one over
documents labelled good (target).  A token is the shape of a word - its length,
capitals, digits, punctuation, and whether it repeats the word before - so the
models describe form in any language, not topic.  Unigrams and bigrams of
shapes are hashed into buckets.  A document's log importance is the sum over its
n-grams of log target - log raw, and that is its log weight.  A caller may temper
it: with ``effective``, the log weight is the mean over the n-grams times that
number, so that every document's weight counts for as many and length does not decide.
Documents are drawn without replacement by Gumbel top-k: the k largest
of log weight + Gumbel noise.  k is the number of documents whose importance per
n-gram makes good likelier than not.

The raw model counts every document.  The target model is fitted on a bounded
sample of labelled documents (``SAMPLE``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import renamed, running_total, stored
from mirrorsmith.llm.text import byte_values, chunks, hash_ranges, mix64, word_ranges

BUCKETS = 1 << 14
SAMPLE = 20_000      # labelled documents at most that the target model is fitted on
SEED = 4
HELD_OUT = 5         # `judged` holds a label out if crc32(doc_id) mod HELD_OUT is 0

_UPPER, _LOWER, _DIGIT, _PUNCT, _STOP, _CONT = range(6)


def _classes() -> np.ndarray:
    """Byte classes, one row each: capitals, small letters (all non-ASCII counts as such), digits, punctuation, full stop or comma, UTF-8 continuation."""
    b = np.arange(256)
    upper, digit = (b >= 65) & (b <= 90), (b >= 48) & (b <= 57)
    lower = ((b >= 97) & (b <= 122)) | (b >= 128)
    stop = (b == 44) | (b == 46)
    punct = (b < 128) & (b > 32) & ~upper & ~lower & ~digit & ~stop
    return np.stack([upper, lower, digit, punct, stop, (b & 0xC0) == 0x80])


def shapes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shape of each word (a small number) and the row offsets into the words."""
    starts, ends, row = word_ranges(buf, off)
    if not len(starts):
        return np.zeros(0, np.int64), row
    kinds = _classes()
    count = lambda k: (c := np.concatenate([[0], np.cumsum(kinds[k][buf])]))[ends] - c[starts]
    chars = ends - starts - count(_CONT)
    length = np.searchsorted([2, 3, 4, 6, 9, 15, 30], chars, "right")
    upper, lower = count(_UPPER), count(_LOWER)
    head = kinds[_UPPER][buf[starts]]
    case = np.where(upper == 0, np.where(lower > 0, 0, 1), np.where((upper == 1) & head & (lower > 0), 2, np.where(lower == 0, 3, 4)))
    tail = np.where(kinds[_STOP][buf[ends - 1]], 1, np.where(kinds[_PUNCT][buf[ends - 1]], 2, 0))
    h = hash_ranges(buf, starts, ends, byte_values(51, lower=False))
    again = np.zeros(len(h), np.int64)
    again[1:] = h[1:] == h[:-1]
    again[row[:-1][row[:-1] < len(h)]] = 0
    shape = length
    for value, size in ((case, 5), (tail, 3), (np.minimum(count(_PUNCT), 3), 4), (np.minimum(count(_DIGIT), 2), 3), (again, 2)):
        shape = shape * size + value
    return shape, row


def ngram_buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram: unigrams in the first half, bigrams in the second."""
    shape, row = shapes(buf, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(row))
    s = shape.astype(np.uint64)
    half = np.uint64(BUCKETS // 2)
    one = (mix64(s + np.uint64(1)) % half).astype(np.int64)
    two = (mix64(s[:-1] * np.uint64(1 << 20) + s[1:] + np.uint64(1 << 50)) % half + half).astype(np.int64)
    same = doc[1:] == doc[:-1]
    return np.concatenate([one, two[same]]), np.concatenate([doc, doc[1:][same]])


@dataclass
class Model:
    log_ratio: np.ndarray    # per bucket: log target - log raw
    good: float              # share of good labels


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the buckets over a partition: in all documents, in those marked good."""
    total = np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        good = b.column(1).to_numpy(zero_copy_only=False)
        for first, last, buf, off in chunks(b.column(0)):
            bucket, doc = ngram_buckets(buf, off)
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket[good[first + doc]], minlength=BUCKETS)
    some = np.flatnonzero(total[0])
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[0][some]), pa.array(total[1][some])], names=["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Count both models.  Labels without a doc_id or quality are left out."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality")).filter("_id IS NOT NULL AND _quality IS NOT NULL")
    # A bounded sample, the same in every run.
    drawn = known.orderBy(F.xxhash64("_id", F.lit(SEED)), "_id").limit(sample)
    share = drawn.agg(F.avg("_quality")).first()[0]
    good = drawn.filter("_quality = 1").select("_id").distinct().withColumn("_good", F.lit(True))
    counted = docs.select("doc_id", "text").join(F.broadcast(good), F.col("doc_id").cast("long") == F.col("_id"), "left") \
        .select("text", F.coalesce("_good", F.lit(False)).alias("good")).mapInArrow(_counts, "bucket long, raw long, target long") \
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.collect():   # one row per bucket: BUCKETS at most
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratio = np.zeros(BUCKETS)
    for part in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
        if target[part].sum():
            # Bounded below by one count in the sample, so that what good documents never show weighs against a text but not without bound.
            p = (target[part] + 0.5) / (target[part].sum() + 0.5 * BUCKETS / 2)
            q = (raw[part] + 0.5) / (raw[part].sum() + 0.5 * BUCKETS / 2)
            ratio[part] = np.log(p / q)
    return Model(ratio, 1.0 if share is None else share)


def _scorer(model: Model, effective: int | None, columns: int, keep: float | None = None, id_at: int = 0, text_at: int = 1):
    """Rows to (doc_id, n, log_importance, log_weight, key); with ``keep``, the rows themselves whose key reaches the cut."""
    ratio = model.log_ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, weight = [], []
            for _, _, buf, off in chunks(b.column(text_at)):
                bucket, doc = ngram_buckets(buf, off)
                n.append(np.bincount(doc, minlength=len(off) - 1))
                weight.append(np.bincount(doc, ratio[bucket], minlength=len(off) - 1).astype(float))
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            weight = np.concatenate(weight) if weight else np.zeros(0)
            importance = weight
            if effective is not None:
                weight = importance * (effective / np.maximum(n, 1))
            key = weight + b.column(columns).to_numpy(zero_copy_only=False)
            if keep is None:
                yield pa.RecordBatch.from_arrays([b.column(id_at), pa.array(n, pa.int64()), pa.array(importance, pa.float64()), pa.array(weight, pa.float64()), pa.array(key, pa.float64())],
                                                 names=["doc_id", "n", "log_importance", "log_weight", "key"])
            else:
                yield pa.RecordBatch.from_arrays([c for c in b.columns[:columns]], names=b.schema.names[:columns]).filter(pa.array(key >= keep))
    return run


def gumbel(doc_id: str = "doc_id") -> Column:
    """Gumbel noise that depends on the document alone, so every run draws the same."""
    u = (F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)), F.lit(SEED + 1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def scores(docs: DataFrame, model: Model, effective: int | None = None) -> DataFrame:
    """Per document: doc_id, n (n-grams), log_importance (their plain sum), log_weight, key (log weight + noise)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", gumbel().alias("noise")) \
        .mapInArrow(_scorer(model, effective, 2), "doc_id long, n long, log_importance double, log_weight double, key double")


def likely_good(model: Model, effective: int | None = None) -> Column:
    """Whether the importance of one n-gram, on average, makes good likelier than not: share x weight >= 1/2."""
    one = F.col("log_weight") / (F.greatest(F.col("n"), F.lit(1)) if effective is None else effective)
    return one >= math.log(0.5 / max(model.good, 1e-9))


def cut(scored: DataFrame, k: int) -> float:
    """The k-th largest key (all of its equals are drawn too)."""
    if k <= 0:
        return math.inf
    ranked = running_total(scored.select("key"), [F.col("key").desc()], {"upto": F.lit(1)}, "quality-rank")
    return ranked.filter(F.col("upto") >= k).agg(F.max("key")).first()[0]


def quality_report(docs: DataFrame, labels: DataFrame, effective: int | None = None) -> DataFrame:
    """Per document: doc_id, n, log_importance, log_weight, key and whether it is drawn (kept).

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other
    columns are ignored.  The log weight is the plain log importance; with
    ``effective``, every document's weight counts for that many n-grams.  A null
    or blank text has weight 0 and is judged by that alone.
    Rows that share a doc_id share their noise, each has its own weight.
    Without labels, every document is drawn.
    """
    model = fit(docs, labels)
    scored = stored(scores(docs, model, effective), "quality-scores")
    at = cut(scored, scored.filter(likely_good(model, effective)).count())
    return scored.withColumn("kept", F.col("key") >= F.lit(at))


def judged(docs: DataFrame, labels: DataFrame, effective: int | None = None) -> DataFrame:
    """How labels that the model has not seen fare: quality, kept, documents.

    A fifth of the labels, by their doc_id, is held out of the fit.  A document
    labelled twice counts as good if any label says so.
    """
    held = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % HELD_OUT == 0
    known = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    unseen = known.filter(held).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    return quality_report(docs, known.filter(~held), effective).join(unseen, "doc_id").groupBy("quality", "kept").agg(F.count("*").alias("documents"))


def draw(docs: DataFrame, labels: DataFrame, effective: int | None = None) -> DataFrame:
    """The drawn documents, with all columns.  Texts are scored again rather than shuffled."""
    model = fit(docs, labels)
    scored = stored(scores(docs, model, effective), "quality-scores")
    at = cut(scored, scored.filter(likely_good(model, effective)).count())
    rows, name = renamed(docs)
    return rows.withColumn("noise", gumbel(name["doc_id"])).mapInArrow(
        _scorer(model, effective, len(name), at, docs.columns.index("doc_id"), docs.columns.index("text")), rows.schema).toDF(*docs.columns)
