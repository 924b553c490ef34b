"""Labelled samples for the classifiers, and their hold-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hold_out(modulus: int, remainder: int, id_col: str = "doc_id") -> Column:
    """Whether a row's labels may not be learned from: by crc32 of the id's text. False without id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, held_out: Column, bound: int
) -> DataFrame:
    """At most ``bound`` labelled documents outside the hold-out: those least by a hash of the id.

    The chosen ids are at most ``bound`` rows of two numbers, so they are broadcast. Where ids
    repeat, the bound holds for rows: of those beyond it, equal in id, the texts of least hash stay.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *_others(documents))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(bound)


def _others(documents: DataFrame) -> list[str]:
    return [c for c in ("text", "n_chars") if c in documents.columns]
