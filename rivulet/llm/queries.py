"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import (
    common,
    conversation_repair,
    decontamination,
    embedding_dedup,
    html_text,
    lm_scores,
    mixing,
    order_minhash,
    packing,
    quality,
    suffix_index,
    token_counts,
    toxicity,
    vector_codes,
)
from rivulet.llm.oracles import ORACLES as ORACLES


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(common.table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(common.table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(common.table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(documents, common.table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(documents, model)


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op6_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.removal_report(common.table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = common.table(spark, sf_dir, "benchmark")
    return decontamination.contamination_report(common.table(spark, sf_dir, "documents"), items)


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scores.score_documents(common.table(spark, sf_dir, "documents"))
    return scored.withColumn("lm_score", F.round("lm_score", 6))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    machine = quality.train_quality(documents, common.table(spark, sf_dir, "labels"))
    return quality.score_quality(documents, machine)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(common.table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(rows)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(common.table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(common.table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_token_counts": op2_token_counts,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_order_minhash": op5_order_minhash,
    "op6_suffix_index": op6_suffix_index,
    "op7_decontamination": op7_decontamination,
    "op8_lm_scores": op8_lm_scores,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_mix": op12_source_mix,
    "op13_vector_codes": op13_vector_codes,
}
