"""One registered query per operator, over its whole table, and its SQL.

Each query applies its operator with production parameters and returns the
full result; the digests of a query's contract are derived from the
operator's output here or in the operator's report function.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mirrorsmith.llm import alignment, ann, fingerprint, licenses, linededup, mix, neardup, packing, quality, simhash, toxicity, warc, whitening
from mirrorsmith.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_report(table(spark, sf_dir, "documents"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(spark, warc.write_archive(table(spark, sf_dir, "pages")), whole=True).drop("record")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(table(spark, sf_dir, "documents"))


def op11_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_warc_archive": op2_warc_archive,
    "op3_license_scan": op3_license_scan,
    "op4_quality": op4_quality,
    "op5_nearest_vectors": op5_nearest_vectors,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_toxicity": op7_toxicity,
    "op8_pack_tokens": op8_pack_tokens,
    "op9_line_dedup": op9_line_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_simhash_groups": op11_simhash_groups,
    "op12_alignment": op12_alignment,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op1_mix_sources": mix.ORACLE,
    "op2_warc_archive": warc.ORACLE,
    "op6_near_duplicates": neardup.ORACLE,
    "op9_line_dedup": linededup.ORACLE,
}
