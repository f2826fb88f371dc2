"""The corpus pipeline: documents pass five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import decontaminate, mixing, quality, secret_scan, simhash
from wakeline.llm.common import kept_table, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (three-word shingles, three bits) stays."""
    return simhash.deduplicate(docs, words=3, bits=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, up to its error budget, go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    return secret_scan.redact(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 1 or 2 ``copies``; those that it does not take go."""
    return mixing.apply_mix(docs)


STAGES = [
    ("quality classifier", reject_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_to_targets),
]

#: SQL cannot express all stages; tests hold each operator against a brute-force version, or its effects on planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus of the ``documents`` below ``sf_dir``: columns of documents and ``copies``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
