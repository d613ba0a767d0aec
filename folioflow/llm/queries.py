"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import chat, decontamination, embedding_dup, language, line_dedup, merkle, mixing, near_dup, quality, sharding, token_counts, warc, whitening
from folioflow.session import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.numbered_shards(table(spark, sf_dir, "documents"), shards=16)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", (F.col("lang") != F.col("lang_best")).alias("rejected"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digest(chat.format_conversations(chat.text_parts(rows.unionByName(extra))))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_sharding, op3_language, op4_token_counts, op5_near_dup, op6_chat, op7_quality, op8_embedding_dup, op9_decontamination, op10_mixing, op11_warc, op12_whitening, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE, "op5_near_dup": near_dup.ORACLE, "op6_chat": chat.ORACLE, "op8_embedding_dup": embedding_dup.ORACLE, "op9_decontamination": decontamination.ORACLE, "op11_warc": warc.ORACLE, "op13_merkle": merkle.ORACLE}
