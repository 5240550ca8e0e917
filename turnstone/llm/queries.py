"""One query for each operator, over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnstone.llm import chat, decontamination, divergence, embedding_dedup, jaccard, langid, mixing, personal, resampling, secrets, substring_dedup, token_counts, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(_table(spark, sf_dir, "conversations"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(_table(spark, sf_dir, "pages"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(_table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_mixing, op3_chat_format, op4_language_id, op5_embedding_dedup, op6_secrets, op7_token_counts, op8_decontamination, op9_jaccard_join, op10_warc, op11_divergence, op12_resampling, op13_personal)}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": substring_dedup.ORACLE_SQL, "op2_mixing": mixing.ORACLE_SQL, "op3_chat_format": chat.ORACLE_SQL, "op5_embedding_dedup": embedding_dedup.ORACLE_SQL, "op8_decontamination": decontamination.ORACLE_SQL, "op9_jaccard_join": jaccard.ORACLE_SQL, "op10_warc": warc.ORACLE_SQL, "op11_divergence": divergence.ORACLE_SQL, "op12_resampling": resampling.ORACLE_SQL}
