"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5, with word ends), of its beginnings (up
to 8 characters, for compounds) and of itself; its vector is the mean of their embeddings,
so an unseen misspelling shares most of its vector with the word it stands for. The vectors
of a document's most toxic words, ``top_words`` of them, are averaged into a softmax of two
classes: a single odd word makes no toxic document, and where words stand does not matter.
Embeddings and softmax are trained jointly in numpy on at most ``max_labelled`` labelled
rows: first on whole documents, then on the most toxic words of each. As the softmax is linear, a
trained model needs one number per n-gram, and a word's share is looked up once.

Null and empty texts have no words and get the score of the bias. Repeated rows get a row
each, an empty table gives none, and without labelled rows every score is one half.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.labelled import hold_out, labelled_sample

LEAST_WORDS, WORDS_A_TOP = 3, 100
_WORD = re.compile(r"\b\d*+[^\W\d]\w*")


def words_of(text: str) -> list[str]:
    """Words have a letter; bare numbers are none."""
    return _WORD.findall(text.lower())


def ngrams(word: str, buckets: int) -> list[int]:
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
    parts += [marked[:n] for n in range(6, min(len(marked), 10))]
    parts.append(marked + "*")
    return [zlib.crc32(p.encode()) % buckets for p in parts]


def top_words(n: int | np.ndarray) -> int | np.ndarray:
    """How many words of a document of ``n`` words are averaged: some at least, and a share of all."""
    return np.minimum(n, LEAST_WORDS + n // WORDS_A_TOP)


@dataclass(frozen=True)
class ToxicModel:
    """The difference of the two classes' logits: per n-gram, and the bias."""

    share: np.ndarray
    bias: float

    def scorer(self, max_words: int = 300_000) -> _Shares:
        return _Shares(self, max_words)


class _Shares(dict):
    """A word's share of the logit, looked up once."""

    def __init__(self, model: ToxicModel, max_words: int):
        super().__init__()
        self.model, self.max_words = model, max_words

    def __missing__(self, word: str) -> float:
        found = self[word] = float(self.model.share[ngrams(word, len(self.model.share))].mean())
        return found

    def score(self, text: str) -> float:
        if len(self) > self.max_words:
            self.clear()
        words = words_of(text)
        logit = self.model.bias
        if words:
            shares = np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))
            n, k = len(words), int(top_words(len(words)))
            logit += float(np.partition(shares, n - k)[n - k :].mean())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def fit(
    texts: list[str],
    labels: list[int],
    buckets: int = 1 << 18,
    width: int = 4,
    min_docs: int = 5,
    whole_epochs: int = 8,
    top_epochs: int = 30,
    rate: float = 0.05,
    decay: float = 1e-5,
    seed: int = 11,
) -> ToxicModel:
    """Adam over the whole sample: first whole documents, then each one's most toxic words.

    N-grams of fewer than ``min_docs`` documents keep an embedding of zero.
    """
    numbers: dict[str, int] = {}
    docs = [
        np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], dtype=np.int32) for t in texts
    ]
    use = [i for i, d in enumerate(docs) if len(d)]
    if not use:
        return ToxicModel(np.zeros(buckets), 0.0)
    words = np.concatenate([docs[i] for i in use])
    doc_sizes = np.array([len(docs[i]) for i in use])
    doc_starts = np.cumsum(doc_sizes) - doc_sizes
    word_doc = np.repeat(np.arange(len(use)), doc_sizes)
    target = np.array([labels[i] for i in use], dtype=np.float64)
    grams, bag_ends = array("i"), array("q", [0])
    for w in numbers:
        grams.extend(ngrams(w, buckets))
        bag_ends.append(len(grams))
    numbers.clear()
    flat, ends = np.frombuffer(grams, dtype=np.int32), np.frombuffer(bag_ends, dtype=np.int64)
    in_docs = np.zeros(buckets, dtype=np.int32)
    for doc in docs:
        if len(doc):
            in_docs[np.unique(np.concatenate([flat[ends[w] : ends[w + 1]] for w in np.unique(doc)]))] += 1
    kept = np.flatnonzero(in_docs >= min_docs)
    place = np.full(buckets, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))
    bag_sizes = np.diff(ends)
    flat, owner = place[flat], np.repeat(np.arange(len(bag_sizes), dtype=np.int32), bag_sizes)
    n_words, known = len(bag_sizes), flat >= 0
    owner, flat = owner[known], flat[known]
    weight = (1 / bag_sizes).astype(np.float32)[owner]

    rng = np.random.default_rng(seed)
    emb, soft = rng.normal(0, 0.1, (len(kept), width)), rng.normal(0, 0.1, (width, 2))
    bias = np.zeros(2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emb, soft, bias)]

    def update(grads: list[np.ndarray], step: int) -> None:
        for p, g, (m, v) in zip((emb, soft, bias), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)

    for epoch in range(whole_epochs + top_epochs):
        vectors = np.stack([np.bincount(owner, emb[:, k][flat] * weight, n_words) for k in range(width)], axis=1)
        if epoch < whole_epochs:
            order, starts, sizes = np.arange(len(words)), doc_starts, doc_sizes
        else:
            share = (vectors @ (soft[:, 1] - soft[:, 0]))[words]
            sizes = top_words(doc_sizes)
            order, starts = np.lexsort((share, word_doc)), doc_starts + doc_sizes - sizes
        rows = np.repeat(np.arange(len(use)), sizes)
        within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chosen = words[order[np.repeat(starts, sizes) + within]]
        hidden = np.stack([np.bincount(rows, vectors[:, k][chosen]) for k in range(width)], axis=1) / sizes[:, None]
        logits = hidden @ soft + bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        error = p.copy()
        error[:, 1] -= target
        error[:, 0] -= 1 - target
        error /= len(use)
        to_doc = error @ soft.T / sizes[:, None]
        per_word = np.stack([np.bincount(chosen, to_doc[:, k][rows], n_words) for k in range(width)], axis=1)
        to_emb = np.stack(
            [np.bincount(flat, per_word[:, k][owner] * weight, len(kept)) for k in range(width)], axis=1
        )
        update([to_emb + decay * emb, hidden.T @ error + decay * soft, error.sum(axis=0)], epoch + 1)
    share = np.zeros(buckets)
    share[kept] = emb @ (soft[:, 1] - soft[:, 0])
    return ToxicModel(share, float(bias[1] - bias[0]))


def train_toxicity(documents: DataFrame, labels: DataFrame, max_labelled: int = 4000) -> ToxicModel:
    """A model fitted on at most ``max_labelled`` rows outside the hold-out."""
    sample = labelled_sample(documents, labels, "toxic", hold_out(4, 2), max_labelled)
    rows = sorted((r.doc_id, r.text or "", r.label) for r in sample.select("doc_id", "text", "label").toLocalIterator())
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score_toxicity(documents: DataFrame, model: ToxicModel, threshold: float = 0.3) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = model.scorer()
        for batch in batches:
            scores = [shares.score(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return texts.mapInArrow(score, "doc_id long, score double").select(
        "doc_id",
        hold_out(4, 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
