"""Token counts of documents without token ids.

The pieces of each distinct pre-token are counted once; a document's count is the sum
over its pre-tokens. Documents are taken in blocks of bounded size. A block's pre-token
frequencies are dealt by a hash of the pre-token, so each shard meets all occurrences of
its pre-tokens, counts each distinct one once, joins the counts to the frequencies and
adds them up per document. Only sums travel on, to be added by block.

Null texts count as empty. Repeated rows each get a row. An empty table gives none.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common, tokens

#: A posting is one 32-bit number: document in block, then frequency.
_FREQ_BITS = 20
_MAX_FREQ = (1 << _FREQ_BITS) - 1
_ROWS = "shard int, block long, pieces binary, sizes binary, postings binary, docs binary"
_SUMS = "block long, sums binary, docs binary"


def count_tokens(
    documents: DataFrame,
    path: str | None = None,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``path`` names the tokenizer file on every executor. Special strings inside texts
    count as the one token that the tokenizer makes of them.
    """
    path = path or tokens.default_path()
    shards = common.partitions(documents.sparkSession)
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        for ids, block in common.text_blocks(batches):
            yield _block_rows(next(numbers), ids, block, path, shards)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            yield _shard_sums(batch, known, path)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _finish(batches)

    dealt = texts.mapInArrow(frequencies, _ROWS).repartition(shards, "shard")
    sums = dealt.mapInArrow(add_up, _SUMS).repartition(shards, "block")
    counted = sums.mapInArrow(finish, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _block_rows(block: int, ids: list, texts: list[str], path: str, shards: int) -> pa.RecordBatch:
    numbers: dict[str, int] = defaultdict(count().__next__)
    found, specials = [], np.zeros(len(texts), dtype=np.int64)
    for doc, text in enumerate(texts):
        parts = text.split(tokens.SPECIAL)
        specials[doc] = len(parts) - 1
        for part in parts:
            pieces = tokens.pre_tokens(part, path)
            places = np.fromiter(map(numbers.__getitem__, pieces), dtype=np.int64, count=len(pieces))
            found.append(places << 12 | doc)
    pairs, times = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
    while (over := times > _MAX_FREQ).any():
        pairs = np.concatenate([pairs, pairs[over]])
        times = np.concatenate([np.minimum(times, _MAX_FREQ), times[over] - _MAX_FREQ])
        order = np.argsort(pairs, kind="stable")
        pairs, times = pairs[order], times[order]
    postings = ((pairs & 4095) << _FREQ_BITS | times).astype("<u4")
    per_piece = np.bincount(pairs >> 12, minlength=len(numbers))

    pieces = [piece.encode() for piece in numbers]
    shard = np.fromiter((zlib.crc32(piece) % shards for piece in pieces), dtype=np.int64, count=len(pieces))
    order = np.argsort(shard, kind="stable")
    ends = np.cumsum(per_piece)
    starts = ends - per_piece
    rows = {name: [] for name in ("shard", "block", "pieces", "sizes", "postings", "docs")}

    def add(*values) -> None:
        for column, value in zip(rows.values(), values, strict=True):
            column.append(value)

    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1)) if len(order) else np.empty(0, int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        strings = [pieces[i] for i in own]
        sizes = np.array([[len(s) for s in strings], per_piece[own]], dtype="<u4")
        parts = [postings[starts[i] : ends[i]] for i in own]
        add(int(shard[own[0]]), block, b"".join(strings), sizes.tobytes(), np.concatenate(parts).tobytes(), None)
    n_bytes = [len(text.encode()) for text in texts]
    known = [doc_id is not None for doc_id in ids]
    docs = np.array([[i or 0 for i in ids], known, n_bytes, specials], dtype="<i8")
    add(block % shards, block, None, None, None, docs.tobytes())
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))


def _shard_sums(batch: pa.RecordBatch, known: dict[bytes, int], path: str) -> pa.RecordBatch:
    blocks, sums, docs = [], [], []
    for row in batch.to_pylist():
        blocks.append(row["block"])
        docs.append(row["docs"])
        if row["docs"] is not None:
            sums.append(None)
            continue
        lengths, per_piece = np.frombuffer(row["sizes"], "<u4").reshape(2, -1)
        ends = np.cumsum(lengths, dtype=np.int64).tolist()
        text = row["pieces"]
        strings = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if new := [s for s in strings if s not in known]:
            encoded = tokens.tokenizer(path).encode_batch_fast([s.decode() for s in new], add_special_tokens=False)
            known.update(zip(new, map(len, encoded), strict=True))
        counts = np.fromiter(map(known.__getitem__, strings), dtype=np.int64, count=len(strings))
        postings = np.frombuffer(row["postings"], "<u4")
        weights = np.repeat(counts, per_piece) * (postings & _MAX_FREQ)
        sums.append(np.bincount(postings >> _FREQ_BITS, weights=weights).astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array(sums, pa.binary()), pa.array(docs, pa.binary())],
        ["block", "sums", "docs"],
    )


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    heads: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["docs"] is not None:
                heads[row["block"]] = np.frombuffer(row["docs"], "<i8").reshape(4, -1)
            else:
                part = np.frombuffer(row["sums"], "<u4")
                total = totals.setdefault(row["block"], np.zeros(4096, dtype=np.int64))
                total[: len(part)] += part
    for block, (ids, known, n_bytes, specials) in heads.items():
        n_tokens = specials + totals[block][: len(ids)] if block in totals else specials
        doc_id = pa.array(ids, pa.int64(), mask=known == 0)
        yield pa.RecordBatch.from_arrays(
            [doc_id, pa.array(n_bytes), pa.array(n_tokens)], ["doc_id", "n_bytes", "n_tokens"]
        )
