"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is queued in a shuffled order; its virtual finish
time is the source's words up to and including it, divided by the source's
weight.  A second pass over a source queues behind the first.  All copies are
range-sorted by finish time and the queue is cut where the words taken reach
the budget.  A source that is used up drops out and the others go on at their
weights, so its share goes to them by weight.

Everything here is DataFrame work.  Text is read once, to count words; the
rest handles one narrow row per document or per source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import renamed, running_total, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)       # by the sources' rank, repeating
BUDGET = 1.5              # words taken, as a multiple of all words
MAX_PASSES = 2            # a source is used this many times at most
SMALL_SOURCES = 100_000   # source rows up to which the source table is broadcast


def words(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(doc_id: Column) -> Column:
    """Sort key that shuffles documents the same way in every run."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def _place(doc_id: Column) -> Column:
    return F.struct(shuffled(doc_id).alias("h"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("d"))


@dataclass
class Mix:
    queue: DataFrame    # one row per document: doc_id, source, size, rank, source_size, weight, target, used
    sources: DataFrame  # one row per source: rank, weight, source_size, target
    cut: float          # virtual time at which the queue is cut


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
                   max_passes: int = MAX_PASSES) -> tuple[DataFrame, int]:
    """Per source: rank (code point order, null last), weight, size, target,
    and the words of all sources ranked before it; with the total size.

    A target is weight x level, but at most ``max_passes`` x the source's size.
    The level is where the targets add up to the budget; f(r), the budget that
    a level r would use, grows with r, so the sources with f(own limit) within
    the budget are the ones that stop at their limit.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(by_source, [F.col("source").asc_nulls_last()],
                           {"rank": F.lit(1), "upto": F.col("source_size")}, "mix-sources")
    pick = F.array(*[F.lit(w) for w in weights])[((F.col("rank") - 1) % len(weights)).cast("int")]
    ranked = stored(ranked.withColumn("weight", pick.cast("long"))
                    .withColumn("limit", F.col("source_size") * max_passes)
                    .withColumn("full_at", F.col("limit") / F.col("weight"))
                    .withColumn("words_before", F.col("upto") - F.col("source_size")), "mix-ranked")
    all_size, all_weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    filled = running_total(ranked.select("limit", "weight", "full_at"), [F.col("full_at")],
                           {"limits": F.col("limit"), "weights": F.col("weight")}, "mix-levels")
    used = F.col("limits") + F.col("full_at") * (F.lit(all_weight) - F.col("weights"))
    full, full_weight = filled.filter(used <= budget * all_size) \
        .agg(F.coalesce(F.sum("limit"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left = (all_weight or 0) - full_weight
    level = (budget * all_size - full) / left if left > 0 else 0.0
    target = F.when(F.lit(left > 0), F.least(F.col("weight") * F.lit(level), F.col("limit").cast("double"))) \
        .otherwise(F.col("limit").cast("double"))
    return ranked.select("source", "rank", "weight", "source_size", "words_before", target.alias("target")), all_size


def attach_sources(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Join the columns of ``sources``; broadcast only if they are few."""
    right = sources.withColumnRenamed("source", "_source")
    if sources.limit(SMALL_SOURCES + 1).count() <= SMALL_SOURCES:
        right = F.broadcast(right)
    return df.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
             max_passes: int = MAX_PASSES) -> Mix:
    """Queue all documents and find the cut.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are
    ignored.  A null source is a source of its own, ranked last.  A null or
    blank text has size 0 and is never taken.  Rows that share a ``doc_id``
    and a source share one place in the queue and are taken together.  An
    empty table gives empty results.  Targets are met to within the document
    on which each source is cut, since documents are taken whole.
    """
    sizes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words(F.col("text")).alias("size")), "mix-sizes")
    sources, all_size = source_targets(sizes, weights, budget, max_passes)
    sources = stored(sources, "mix-targets")
    placed = attach_sources(sizes, sources).withColumn("place", _place(F.col("doc_id")))
    queued = running_total(placed, [F.col("rank"), F.col("place")], {"upto": F.col("size")}, "mix-queue")
    queued = stored(queued.withColumn("used", F.col("upto") - F.col("words_before")).drop("upto", "words_before"), "mix-queued")
    copies = queued.filter(F.col("size") > 0).select(
        "size", F.explode(F.array(*[finish(p) for p in range(max_passes)])).alias("finish"))
    timed = running_total(copies, [F.col("finish")], {"taken": F.col("size")}, "mix-finish")
    cut = timed.filter(F.col("taken") <= budget * all_size).agg(F.max("finish")).first()[0]
    return Mix(queued, sources, -1.0 if cut is None else cut)


def finish(done_passes: int) -> Column:
    """Virtual finish time of a document in its source's pass number ``done_passes``."""
    return (F.col("used") + F.col("source_size") * done_passes) / F.col("weight")


def times_taken(cut: float, max_passes: int = MAX_PASSES) -> Column:
    return sum((F.when(finish(p) <= cut, 1).otherwise(0) for p in range(max_passes)), F.lit(0))


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, words taken."""
    m = plan_mix(docs)
    return m.queue.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * times_taken(m.cut)).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
                  max_passes: int = MAX_PASSES) -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is taken.

    A source takes its documents in shuffled order, so a pass ends at one
    place of that order.  The places (a row per source) are joined to the
    documents; texts are not shuffled.
    """
    m = plan_mix(docs, weights, budget, max_passes)
    last = m.queue.groupBy("source").agg(*[F.max(F.when(finish(p) <= m.cut, F.col("place"))).alias(f"_last{p}") for p in range(max_passes)])
    last = stored(last, "mix-last")
    times = sum((F.when(F.col("_place") <= F.col(f"_last{p}"), 1).otherwise(0) for p in range(max_passes)), F.lit(0))
    rows, name = renamed(docs)
    # A blank document has no words to take; it goes nowhere.
    rows = rows.filter(words(F.col(name["text"])) > 0) \
        .withColumns({"source": F.col(name["source"]), "_place": _place(F.col(name["doc_id"]).cast("long"))})
    return attach_sources(rows, last).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(max_passes)))) \
        .filter(F.col("_copy") <= times).select(*name.values()).toDF(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
src AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM src),
tot AS (SELECT CAST(SUM(s) AS DOUBLE) AS t, CAST(SUM(w) AS BIGINT) AS tw FROM weighed),
lev AS (
  SELECT 2 * s AS c, w, CAST(2 * s AS DOUBLE) / w AS f,
         CAST(SUM(2 * s) OVER (ORDER BY CAST(2 * s AS DOUBLE) / w) AS DOUBLE) AS cc,
         CAST(SUM(w) OVER (ORDER BY CAST(2 * s AS DOUBLE) / w) AS BIGINT) AS cw
  FROM weighed),
sat AS (
  SELECT CAST(COALESCE(SUM(c), 0) AS DOUBLE) AS c, CAST(COALESCE(SUM(w), 0) AS BIGINT) AS w
  FROM lev, tot WHERE cc + f * (tw - cw) <= 1.5 * t),
v AS (SELECT (1.5 * t - sat.c) / (tw - sat.w) AS level FROM tot, sat),
tgt AS (SELECT weighed.*, least(w * level, CAST(2 * s AS DOUBLE)) AS target FROM weighed, v),
q AS (
  SELECT d.doc_id, d.size, g.s, g.w, g.target,
         CAST(SUM(d.size) OVER (PARTITION BY g.r ORDER BY d.h, d.doc_id) AS BIGINT) AS used
  FROM sized d JOIN tgt g ON d.source IS NOT DISTINCT FROM g.source),
cp AS (
  SELECT size, CAST(used AS DOUBLE) / w AS f FROM q WHERE size > 0
  UNION ALL SELECT size, CAST(used + s AS DOUBLE) / w FROM q WHERE size > 0),
run AS (SELECT f, SUM(size) OVER (ORDER BY f) AS taken FROM cp),
cut AS (SELECT MAX(f) AS f FROM run, tot WHERE taken <= 1.5 * t)
SELECT doc_id, size, s AS source_size, target,
       CAST(size * (CASE WHEN CAST(used AS DOUBLE) / w <= cut.f THEN 1 ELSE 0 END
                  + CASE WHEN CAST(used + s AS DOUBLE) / w <= cut.f THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM q, cut
"""
