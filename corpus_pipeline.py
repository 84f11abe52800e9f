"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last returns packed pieces.  ``run`` writes
every stage's rows as Parquet in the shared folder and reads them back for the
next, so a lost executor costs one stage at most.

1. quality: documents drawn by importance resampling stay.  Weights are tempered
   to ``EFFECTIVE`` n-grams, so that a long clean document whose n-grams are each a
   little rarer than usual is not outranked by a short poor one.
2. line_dedup: lines that an earlier document holds go; documents stay.
3. near_dedup: one document of each group of near duplicates stays (five-word
   shingles, similarity 0.8).
4. mix: documents as often as the mix takes them, at most twice.
5. pack: token sequences of 2048 and shorter powers of two.

Nulls: a null text is blank.  A document without words has no evidence against
it and passes 1-3, is never taken by 4.  An empty table gives an empty result.
Columns besides doc_id, text, source and n_chars are carried along unread.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorsmith.llm import linededup, mix, neardup, packing, quality
from mirrorsmith.llm.common import stored, table

EFFECTIVE = 64   # n-grams that each document's weight counts for in the quality stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.draw(docs, table(spark, sf_dir, "labels"), EFFECTIVE)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = linededup.drop_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else kept


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mix_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dedup_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

# The quality model and the tokenizer cannot be put in SQL; tests/llm compares
# each stage with a plain version on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
