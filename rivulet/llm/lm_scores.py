"""Stupid-backoff language-model scores from count tables over all documents.

Documents are taken in blocks. A block's distinct n-grams with their counts are exploded by
ranges of their hash; a shard adds up the count table of its range and joins it back to
the blocks' n-grams; a block sums its documents' scores. Only n-grams of blocks and their
counts travel, so no word is hot: it comes once per block. Blocks are small and their texts
compressed, as executors hold several whole rows at once.

A document is no evidence for itself: its own occurrences are taken off every count. With
counts ``c`` so reduced and ``N`` words in the other documents, a word ``w`` after ``v``
scores ``c(vw) / c(v)``, else ``alpha`` times its unigram score, which is ``c(w) / N``, else
``alpha / N``. Words are runs of ASCII letters and digits and of characters beyond ASCII,
with A-Z as a-z. Texts without words (null, empty) score null, as does everything when no
other document has words. Repeated rows count as documents of their own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common
from rivulet.llm.decontamination import words_of

_BLOCK = "block long, rows binary, n_words long"
#: Characters of a block's texts. Smaller blocks share fewer n-grams, so more of them travel.
_BLOCK_SIZE = 4 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class BlockGrams:
    """The words and word pairs of a block's texts, by 64-bit hash."""

    def __init__(self, texts: Iterable[str]):
        import xxhash

        numbers: dict[bytes, int] = defaultdict(count().__next__)
        found = []
        for text in texts:
            words = words_of(text)
            found.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
        self.sizes = np.array([len(f) for f in found])
        self.doc = np.repeat(np.arange(len(found)), self.sizes)
        local = np.concatenate(found) if found else np.empty(0, np.int64)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))
        self.word_keys, place = np.unique(hashes, return_inverse=True)
        self.words = place[local]
        self.follows = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1
        keys = _mix(hashes[local[self.follows - 1]] * np.uint64(0x9E3779B97F4A7C15) + hashes[local[self.follows]])
        self.pair_keys, self.pairs = np.unique(keys, return_inverse=True)

    def orders(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        return [(1, self.word_keys, self.words), (2, self.pair_keys, self.pairs)]

    def own(self, ids: np.ndarray, docs: np.ndarray, kinds: int) -> np.ndarray:
        """How often each n-gram occurs in its own document."""
        _, where, times = np.unique(docs * np.int64(max(1, kinds)) + ids, return_inverse=True, return_counts=True)
        return times[where]


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, which compresses well if most are small."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _packed(values: np.ndarray) -> bytes:
    """Rising 64-bit numbers as their differences."""
    return _planes(np.diff(values, prepend=np.uint64(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data), dtype=np.uint64)


def _stored(ids: list, texts: list[str]) -> bytes:
    """Documents of a block as compressed bytes."""
    rows = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)
    with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def stored_rows(data: bytes) -> pa.RecordBatch:
    """The ``doc_id`` and ``text`` of the documents of a block."""
    return pa.ipc.open_stream(data).read_next_batch()


def _texts(rows: pa.RecordBatch) -> Iterator[str]:
    return (text.as_py() for text in rows.column("text"))


def text_table(documents: DataFrame) -> DataFrame:
    """The documents in blocks of bounded size, one row each."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        for ids, block in common.text_blocks(batches, max_bytes=_BLOCK_SIZE):
            n = sum(len(words_of(text)) for text in block)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers)], pa.int64()),
                    pa.array([_stored(ids, block)], pa.binary()),
                    pa.array([n], pa.int64()),
                ],
                ["block", "rows", "n_words"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return common.written(texts.mapInArrow(gather, _BLOCK), "blocks", "uncompressed")


def count_tables(blocks: DataFrame, shards: int) -> DataFrame:
    """Counts over all blocks for each block's n-grams, by order and hash range."""
    width = -(-(2**64) // shards)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for order, keys, ids in BlockGrams(_texts(stored_rows(data.as_py()))).orders():
                    times = np.bincount(ids, minlength=len(keys)).astype("<u4")
                    edges = np.searchsorted(keys, np.array([width * s for s in range(shards)], dtype=np.uint64))
                    for shard, (a, b) in enumerate(zip(edges, [*edges[1:], len(keys)], strict=True)):
                        if a < b:
                            rows.append((shard, order, block, _packed(keys[a:b]), times[a:b].tobytes()))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["shard", "gram_order", "block", "grams", "times"],
                )

    def add_up(group: pa.Table) -> pa.Table:
        keys = [_unpacked(x.as_py()) for x in group.column("grams")]
        times = [np.frombuffer(x.as_py(), "<u4") for x in group.column("times")]
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(where, weights=np.concatenate(times)).astype("<i8")
        ends = np.cumsum([len(k) for k in keys])
        counts = [_planes(totals[where[e - len(k) : e]]) for k, e in zip(keys, ends, strict=True)]
        return pa.table(
            {n: group.column(n) for n in ("block", "gram_order", "shard")} | {"counts": pa.array(counts, pa.binary())}
        )

    rows = blocks.select("block", "rows").mapInArrow(
        explode, "shard int, gram_order int, block long, grams binary, times binary"
    )
    return rows.groupBy("shard", "gram_order").applyInArrow(
        add_up, "block long, gram_order int, shard int, counts binary"
    )


def score_documents(documents: DataFrame, alpha: float = 0.4) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``n_words``, ``n_backoff`` and ``lm_score``, the mean log score."""
    blocks = text_table(documents)
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    counts = count_tables(blocks, 2 * common.partitions(documents.sparkSession))

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*(found.column(c).to_pylist() for c in ("gram_order", "shard", "counts")), strict=True),
            key=lambda r: r[:2],
        )
        tables = {
            n: np.concatenate([np.empty(0, np.uint64), *(_numbers(r[2]) for r in rows if r[0] == n)]).astype(np.int64)
            for n in (1, 2)
        }
        return pa.Table.from_batches(
            _scores(stored_rows(data.as_py()), tables, total, alpha) for data in texts.column("rows")
        )

    return (
        blocks.select("block", "rows")
        .groupBy("block")
        .cogroup(counts.groupBy("block"))
        .applyInArrow(score, "doc_id long, n_words long, n_backoff long, lm_score double")
    )


def _scores(rows: pa.RecordBatch, tables: dict[int, np.ndarray], total: int, alpha: float) -> pa.RecordBatch:
    grams = BlockGrams(_texts(rows))
    n = rows.num_rows
    words = tables[1][grams.words] - grams.own(grams.words, grams.doc, len(grams.word_keys))
    others = (total - grams.sizes)[grams.doc]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(words > 0, np.log(words / others), np.log(alpha / others))
        at = grams.follows
        pairs = tables[2][grams.pairs] - grams.own(grams.pairs, grams.doc[at], len(grams.pair_keys))
        score[at] = np.where(pairs > 0, np.log(pairs / words[at - 1]), np.log(alpha) + score[at])
        backed = np.bincount(grams.doc[at], weights=pairs == 0, minlength=n).astype(np.int64)
        mean = np.bincount(grams.doc, weights=score, minlength=n) / grams.sizes
    valid = np.isfinite(mean)
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), pa.array(grams.sizes, pa.int64()), pa.array(backed), pa.array(mean, mask=~valid)],
        ["doc_id", "n_words", "n_backoff", "lm_score"],
    )
