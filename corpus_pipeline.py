"""A training corpus from `documents`: identified languages, one of each near-duplicate group, no benchmark text,
no secrets, mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnstone.llm import decontamination, jaccard, langid, mixing, secrets
from turnstone.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no language, or in too uncertain a one."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents that are linked by similar shingle sets."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With secrets masked in text."""
    return secrets.mask_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture reads, with n_copies."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]

#: Language models, networks and component search can't be put in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
