"""From raw documents to packed training sequences, in stages.

Each stage works on what its predecessor kept, with the columns of ``documents``. Rows
that repeat an id or have none are documents of their own; null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import common, decontamination, order_minhash, packing, quality, suffix_index


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    machine = quality.train_quality(docs, common.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, machine)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return order_minhash.keep_representatives(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that came earlier are cut out."""
    return suffix_index.remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontamination.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", benchmark_decontamination),
    ("packing", best_fit_packing),
]

#: The classifier and the token ids have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
