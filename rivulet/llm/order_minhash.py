"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is its sequence of five-word shingles, each labelled with its occurrence
number. A sketch takes the ``LENGTH`` labelled shingles of least hash and keeps them in
text order, so two documents share it if they share these shingles in the same order; that
is sensitive to edit similarity, not only to the sets of shingles. Documents that share
one of the first ``KEYS`` sketches are candidates if they share ``LEAST_SHARED`` of all
``SKETCHES``. At similarity 0.8 a pair shares a key but for one case in five thousand, of
texts of nine words for one in five hundred; of the others fewer than one in ten thousand
share no second sketch.
A candidate is linked if the best alignment of the shingle sequences within the band that
the threshold allows matches at least 0.8 of all shingles.

Copies with equal words are one class from the start. Each document is first aligned with
the least document of each of its buckets. Buckets whose members are then in one class are
done; the others are compared across classes, in blocks of bounded size, so no group is
expanded into all its pairs and no link between different classes is left out.

Words are lower-case runs of word characters. A text of fewer than five words is one
shingle; null texts and texts without words link with nothing. Rows with equal ``doc_id``
are one document, the one of the least words; rows without id are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common
from rivulet.llm.components import components

K, LENGTH, SKETCHES, KEYS, LEAST_SHARED, BLOCK = 5, 3, 24, 12, 2, 2048
_WORD = re.compile(r"\w+")
_ODD = np.random.default_rng(2023).integers(1, 2**63, (SKETCHES, 2), dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordNumbers(dict):
    """32-bit numbers of words, looked up once."""

    def __missing__(self, word: str) -> int:
        number = self[word] = zlib.crc32(word.encode())
        return number

    def of(self, text: str) -> np.ndarray:
        if len(self) > 500_000:
            self.clear()
        words = _WORD.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint32, count=len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """64-bit numbers of the five-word shingles, in order."""
    n = min(K, len(words))
    out = np.zeros(max(0, len(words) - n + 1) if n else 0, dtype=np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(out)].astype(np.uint64) + np.uint64(1))
    return out


def labelled(values: np.ndarray) -> np.ndarray:
    """Shingles told apart by their occurrence number."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if new.all():
        return values
    starts = np.flatnonzero(new)
    number = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
    out = np.empty_like(values)
    out[order] = mix(ranked + number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return out


def sketch(values: np.ndarray) -> np.ndarray:
    """``SKETCHES`` numbers, each of the ordered shingles with the least hash values."""
    own = labelled(values)
    hashed = mix(own[None, :] * _ODD[:, :1] + _ODD[:, 1:])
    if len(own) > LENGTH:
        least = np.sort(np.argpartition(hashed, LENGTH - 1, axis=1)[:, :LENGTH], axis=1)
    else:
        least = np.broadcast_to(np.arange(len(own)), (SKETCHES, len(own)))
    out = np.arange(SKETCHES, dtype=np.uint64)
    for at in least.T:
        out = mix(out * np.uint64(31) + own[at])
    return out


def common_length(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence whose pairs are at most ``band`` places apart.

    Bit-parallel: a row of the alignment table is one number, restricted to the band.
    """
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, window = full, (1 << 2 * band + 1) - 1
    for j, x in enumerate(b):
        at = places.get(x, 0)
        if at:
            at &= window << j - band if j >= band else window >> band - j
            match = row & at
            row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether an alignment matches at least ``threshold`` of the shingles of both sequences."""
    n, m = len(a), len(b)
    need = int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))
    if not n or not m or min(n, m) < need:
        return False
    band = max(n, m) - need
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    if short:
        differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
        tail = int(differ[0]) if len(differ) else short
        a, b = a[: len(a) - tail], b[: len(b) - tail]
        head += tail
    if head >= need:
        return True
    x, y = a.tolist(), b.tolist()
    if head + (Counter(x) & Counter(y)).total() < need:
        return False
    return head + common_length(x, y, band) >= need


def sketches(documents: DataFrame) -> DataFrame:
    """Per document: hashes of all words, sketches, and the words' numbers."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        for ids, block in common.text_blocks(batches, max_rows=1024):
            rows = []
            for doc_id, text in zip(ids, block, strict=True):
                words = numbers.of(text)
                if len(words):
                    values = shingles(words)
                    spread = mix(values * np.uint64(2) + np.arange(len(values), dtype=np.uint64))
                    whole = [int(spread.sum().view(np.int64)), int(np.bitwise_xor.reduce(mix(spread)).view(np.int64))]
                    rows.append((doc_id, *whole, sketch(values).view(np.int64).tolist(), words.tobytes()))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["doc", "hash1", "hash2", "sketch", "words"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return texts.mapInArrow(extract, "doc long, hash1 long, hash2 long, sketch array<long>, words binary")


def _shared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def near_duplicates(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Per id of ``documents``: ``class_id``, the least id of its class, and ``kept``."""
    made = common.written(sketches(documents), "sketches")
    same = F.struct("hash1", "hash2")
    least = made.groupBy("doc").agg(F.min(F.struct("hash1", "hash2", "sketch")).alias("least"))
    plain = least.select("doc", F.struct("least.hash1", "least.hash2").alias("hash"), "least.sketch")
    firsts = plain.groupBy("hash").agg(F.min("doc").alias("rep"))
    exact = common.written(plain.join(firsts, "hash"), "copies")
    whole = exact.where("doc = rep").select("doc", "hash", "sketch")

    keys = F.transform(F.slice("sketch", 1, KEYS), lambda x, i: F.struct(i.alias("number"), x.alias("value")))
    members = whole.select("doc", F.explode(keys).alias("key"))
    buckets = members.groupBy("key").agg(F.min("doc").alias("leader"), F.count("*").alias("size")).where("size > 1")
    bucketed = common.written(members.join(buckets, "key"), "buckets")
    # Words of documents that meet others; only these rows travel on.
    meeting = whole.join(bucketed.select("doc").distinct(), "doc").select("doc", "hash")
    words = common.written(
        made.select("doc", same.alias("hash"), "words").join(meeting, ["doc", "hash"], "left_semi").dropDuplicates(["doc"]),
        "words",
    )

    pairs = bucketed.where("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct()
    likely = (
        pairs.join(whole.select(F.col("doc").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        .join(whole.select(F.col("doc").alias("b"), F.col("sketch").alias("sketch_b")), "b")
        .where(_shared(F.col("sketch_a"), F.col("sketch_b")) >= LEAST_SHARED)
        .select("a", "b")
    )
    likely = common.written(likely, "likely")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                aligned(shingles(np.frombuffer(x.as_py(), np.uint32)), shingles(np.frombuffer(y.as_py(), np.uint32)), threshold)
                for x, y in zip(batch.column("words_a"), batch.column("words_b"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_words = likely.join(words.select(F.col("doc").alias("a"), F.col("words").alias("words_a")), "a").join(
        words.select(F.col("doc").alias("b"), F.col("words").alias("words_b")), "b"
    )
    stars = common.written(with_words.select("a", "b", "words_a", "words_b").mapInArrow(verify, "a long, b long"), "stars")
    first = components(stars)

    labelled_members = bucketed.join(first.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    labelled_members = common.written(labelled_members, "members")
    mixed = (
        labelled_members.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (
        labelled_members.join(mixed, "key")
        .withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "doc",
            "component",
            F.col("key.number").alias("number"),
            F.col("key.value").alias("value"),
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
        )
        .join(whole.select("doc", "sketch"), "doc")
        .join(words.select("doc", "words"), "doc")
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for (number, _, low, high), group in groupby(rows, key=itemgetter("number", "value", "low", "high")):
            found = list(_cross_links(list(group), number, low == high, threshold))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"]
                )

    spread = dealt.repartition(common.partitions(documents.sparkSession), "number", "value", "low", "high")
    ordered = spread.sortWithinPartitions("number", "value", "low", "high", "doc")
    more = common.written(ordered.mapInArrow(across, "a long, b long"), "crossings")
    joined = components(first.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more))
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    return (
        ids.join(exact.select(F.col("doc").alias("doc_id"), F.col("rep").alias("node")), "doc_id", "left")
        .join(joined, "node", "left")
        .select("doc_id", F.coalesce("component", "node", "doc_id").alias("class_id"))
        .withColumn("kept", F.col("doc_id") == F.col("class_id"))
    )


def _cross_links(rows: list[dict], number: int, same_block: bool, threshold: float) -> Iterator[tuple[int, int]]:
    """Links between members of a bucket's two blocks that are in different components.

    A pair counts in the first bucket it shares. Pairs that links found here connect
    already are not aligned.
    """
    sketch_of = np.array([r["sketch"] for r in rows], dtype=np.int64)
    component = np.array([r["component"] for r in rows])
    block = np.array([r["block"] for r in rows])
    values: dict[int, np.ndarray] = {}
    parent = {c: c for c in set(component.tolist())}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    def own(i: int) -> np.ndarray:
        if i not in values:
            values[i] = shingles(np.frombuffer(rows[i]["words"], np.uint32))
        return values[i]

    for i in range(len(rows) - 1):
        later = i + 1 + np.flatnonzero(component[i + 1 :] != component[i])
        if not same_block:
            later = later[block[later] != block[i]]
        if not len(later):
            continue
        equal = sketch_of[later] == sketch_of[i]
        fit = (equal.sum(axis=1) >= LEAST_SHARED) & ~equal[:, :number].any(axis=1)
        for j in later[fit].tolist():
            x, y = root(int(component[i])), root(int(component[j]))
            if x != y and aligned(own(i), own(j), threshold):
                parent[max(x, y)] = min(x, y)
                yield rows[i]["doc"], rows[j]["doc"]


def keep_representatives(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of each class of ``documents``, with all columns.

    Each row is compared as a document of its own, also those that repeat an id or have
    none. The row of least id stays, of rows without id only where no other is in the class.
    """
    key = common.fresh("_key", documents)
    own = common.own_ids(documents, key)
    classes = near_duplicates(own.select(F.col(key).alias("doc_id"), "text"), threshold)
    dropped = classes.where(~F.col("kept")).select(F.col("doc_id").alias(key))
    return own.join(dropped, key, "left_anti").select(*(F.col(f"`{c}`") for c in documents.columns))
