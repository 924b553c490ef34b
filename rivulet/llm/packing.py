"""Best-fit packing of tokenised documents into sequences of fixed length.

Bounded-space online best-fit: a fixed number of bins is open at a time, found through a
bitset keyed by free space. A piece goes to the open bin that it fills best; if none has
room, a new bin opens, and beyond the bound the fullest closes first. Tasks pack
independent shares of the pieces, so a share leaves at most the open bins part-filled.

Null texts count as empty: one piece that holds the separator. Repeated rows are packed
each. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common, tokens

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Bins with room, at most ``most`` of them, by free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open = size, most, 0
        self.bits = 0
        self.by_free: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.size
            self.made += 1
        if free > length:
            self.by_free[free - length].append(number)
            self.bits |= 1 << free - length
            self.open += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return number


def token_pieces(documents: DataFrame, size: int, path: str, separator: int = 0) -> DataFrame:
    """Documents as pieces of at most ``size`` ids; only a first piece may be shorter."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    end = np.array([separator], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.IdEncoder(path)
        for ids, block in common.text_blocks(batches):
            rows = []
            for doc_id, text in zip(ids, block, strict=True):
                data = encoder.encode(text) + end
                start, stop = 0, (len(data) // 4 - 1) % size + 1
                piece = 0
                while start < len(data) // 4:
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(data[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + size, piece + 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts.mapInArrow(cut, _PIECES)


_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pack_documents(
    documents: DataFrame,
    size: int = 2048,
    open_bins: int = 1024,
    pieces_per_task: int = 200_000,
    path: str | None = None,
) -> DataFrame:
    """Per piece: its document, place in the document, checksum, sequence and offset there.

    The number of packing tasks grows with the number of pieces, at ``pieces_per_task``.
    """
    pieces = common.written(token_pieces(documents, size, path or tokens.default_path()), "pieces")
    tasks = max(1, math.ceil(pieces.count() / pieces_per_task))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(size, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            sequence, offset = zip(*placed, strict=True) if placed else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    # The same order on every attempt, so that a repeated task packs alike.
    dealt = pieces.repartition(tasks, F.xxhash64("doc_id", "piece"))
    ordered = dealt.sortWithinPartitions("doc_id", "piece", "length", "ids_crc32")
    return ordered.mapInArrow(pack, f"{_PIECES}, sequence_id long, offset long")
