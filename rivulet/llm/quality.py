"""Quality classifier: a factorisation machine over words, structure and metadata.

Features are hashed words (logarithmic counts of unit length), statistics of the text's
structure, each as a value and as a bin, and the stated length. Pairs of features
interact through low-rank factors; a document is scored in time linear in its features,
as half the squared sums minus the sums of squares. The model is fitted in numpy on a
sample of at most ``max_labelled`` labelled rows.

Null and empty texts get the score of their statistics. Repeated rows get a row each, an
empty table gives none, and without labelled rows every score is one half.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common
from rivulet.llm.labelled import hold_out, labelled_sample

_WORD = re.compile(r"\w+")
_BINS = 12
_STATS = 18
_MARKS = np.array([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-"])


@dataclass(frozen=True)
class Machine:
    """Bias, weights and factors; the last features are the statistics and their bins."""

    buckets: int
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        scaled = self.factors[index] * value[:, None]
        sums = scaled.sum(axis=0)
        pairs = 0.5 * float((sums * sums).sum() - (scaled * scaled).sum())
        return self.bias + float(self.weights[index] @ value) + pairs


def structure(text: str, words: list[str], counts: Counter, stated: int | None) -> np.ndarray:
    """Statistics between 0 and about 1."""
    raw = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    size, n = max(1, int(raw.sum())), max(1, len(words))
    lines = text.split("\n")
    letters = max(1, int(raw[65:91].sum() + raw[97:123].sum() + raw[128:].sum() // 2))
    tokens = text.split()
    rare = sum(1 for c in counts.values() if c == 1)
    return np.array(
        [
            math.log1p(size) / 16,
            math.log1p(len(words)) / 14,
            raw[65:91].sum() / letters,
            raw[48:58].sum() / size,
            min(1.0, raw[_MARKS].sum() * 5 / size),
            min(1.0, raw[33] * 5 / size),
            min(1.0, raw[124] * 10 / size),
            min(1.0, (raw[35] + raw[36] + raw[37] + raw[38] + raw[42]) * 3 / size),
            min(1.0, (raw[46] + raw[44]) * 10 / size),
            raw[128:].sum() / size,
            len(counts) / n,
            max(counts.values(), default=0) / n,
            rare / n,
            min(1.0, sum(map(len, words)) / n / 20),
            min(1.0, math.log1p(size / len(lines)) / 10),
            1 - len(set(lines)) / len(lines),
            min(1.0, sum(1 for t in tokens if t.isupper()) / max(1, len(tokens))),
            math.log1p(max(0, stated or 0)) / 16,
        ]
    )


def features(text: str, stated: int | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    words = _WORD.findall(text.lower())
    counts = Counter(words)
    index = np.fromiter((zlib.crc32(w.encode()) % buckets for w in counts), dtype=np.int64, count=len(counts))
    value = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    value /= max(1e-9, math.sqrt(float(value @ value)))
    stats = structure(text, words, counts, stated)
    bins = np.minimum(_BINS - 1, (np.sqrt(np.clip(stats, 0, 1)) * _BINS).astype(np.int64))
    own = buckets + np.arange(_STATS)
    binned = buckets + _STATS + np.arange(_STATS) * _BINS + bins
    return (
        np.concatenate([index, own, binned]).astype(np.int32),
        np.concatenate([value, stats, np.full(_STATS, 0.5)]).astype(np.float32),
    )


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    buckets: int,
    rank: int = 8,
    epochs: int = 12,
    rate: float = 0.02,
    decay: float = 1e-5,
    seed: int = 7,
) -> Machine:
    """Adam on the logistic loss, in batches of 128 documents."""
    rng = np.random.default_rng(seed)
    n = buckets + _STATS * (1 + _BINS)
    theta = np.concatenate([np.zeros((n, 1)), rng.normal(0, 0.02, (n, rank))], axis=1)
    m1, m2, bias, b1, b2 = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0, 0.0
    step = 0
    for _ in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for first in range(0, len(rows), 128):
            some = [rows[i] for i in order[first : first + 128]]
            index = np.concatenate([r[0] for r in some])
            value = np.concatenate([r[1] for r in some]).astype(np.float64)
            sizes = np.array([len(r[0]) for r in some])
            starts = np.cumsum(sizes) - sizes
            label = np.array([r[2] for r in some], dtype=np.float64)
            own = theta[index]
            scaled = own[:, 1:] * value[:, None]
            sums = np.add.reduceat(scaled, starts)
            squares = np.add.reduceat((scaled * scaled).sum(axis=1), starts)
            linear = np.add.reduceat(own[:, 0] * value, starts)
            margin = bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label) / len(some)
            per = np.repeat(error, sizes)
            slope = np.empty_like(own)
            slope[:, 0] = per * value
            slope[:, 1:] = (per * value)[:, None] * (np.repeat(sums, sizes, axis=0) - scaled)
            seen, where = np.unique(index, return_inverse=True)
            grad = np.stack([np.bincount(where, slope[:, k]) for k in range(slope.shape[1])], axis=1)
            grad += decay * theta[seen]
            step += 1
            m1[seen] = 0.9 * m1[seen] + 0.1 * grad
            m2[seen] = 0.99 * m2[seen] + 0.01 * grad * grad
            theta[seen] -= rate * m1[seen] / (np.sqrt(m2[seen]) + 1e-8)
            b1, b2 = 0.9 * b1 + 0.1 * error.sum(), 0.99 * b2 + 0.01 * error.sum() ** 2
            bias -= rate * b1 / (math.sqrt(b2) + 1e-8)
    return Machine(buckets, float(bias), theta[:, 0].astype(np.float32), theta[:, 1:].astype(np.float32))


def train_quality(
    documents: DataFrame, labels: DataFrame, max_labelled: int = 8000, buckets: int = 1 << 16
) -> Machine:
    """A machine fitted on at most ``max_labelled`` rows outside the hold-out."""
    sample = labelled_sample(documents, labels, "quality", hold_out(5, 0), max_labelled)
    stated = F.col("n_chars") if "n_chars" in documents.columns else F.lit(None)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(r["text"] or "", r["n_chars"], buckets) for r in batch.to_pylist()]
            columns = [
                batch.column("doc_id"),
                batch.column("label"),
                pa.array([i.tobytes() for i, _ in found], pa.binary()),
                pa.array([v.tobytes() for _, v in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "index", "value"])

    rows = sample.select("doc_id", "text", stated.cast("long").alias("n_chars"), "label").mapInArrow(
        extract, "doc_id long, label int, index binary, value binary"
    )
    found = sorted(rows.collect())
    return fit(
        [(np.frombuffer(r["index"], np.int32), np.frombuffer(r["value"], np.float32), r["label"]) for r in found], buckets
    )


def score_quality(documents: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents`` with ``held_out``, ``score`` and ``predicted``: id and text are read."""
    stated = F.col("n_chars") if "n_chars" in documents.columns else F.lit(None)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", stated.cast("long").alias("n_chars")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                1 / (1 + math.exp(-max(-30.0, min(30.0, machine.margin(*features(text.as_py() or "", n, machine.buckets))))))
                for text, n in zip(batch.column("text"), batch.column("n_chars").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    scored = texts.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        hold_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents``, all columns, that the machine does not reject."""
    schema = documents.schema
    text, length = documents.columns.index("text"), schema.names.index("n_chars") if "n_chars" in schema.names else None

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = math.log(threshold / (1 - threshold))
        for batch in batches:
            stated = batch.column(length).to_pylist() if length is not None else [None] * batch.num_rows
            good = [
                machine.margin(*features(t.as_py() or "", n, machine.buckets)) >= cut
                for t, n in zip(batch.column(text), stated, strict=True)
            ]
            yield batch.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(keep, schema)
