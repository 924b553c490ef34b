"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learned so that signs of the rotated, centred vectors make balanced binary
codes: on a bounded sample, principal directions first, then turns between the signs and
the rotation that fits them best. Several rotations from different starts lengthen the
code. Its 16-bit parts are indexed in one table each. Vectors of equal label that agree in
a part are compared by the cosine of the original vectors in double precision.

Signs tell the angle seen from the mean, which grows as vectors come near to it: unit
vectors at the threshold's distance are seen under an angle of at most the arc sine of that
distance over the greater of their distances from the mean. A vector is entered in as many
tables as that angle needs to miss fewer than one pair in ``1 / MISS``, so the farther of a
pair's two vectors vouches for the pair. Vectors so near to the mean that they need more
tables than there are, the core, are compared with each other directly. If all vectors fit
into one block, all are.

Equal vectors are one entry with a count. Buckets are compared in blocks of bounded size,
and a task returns sums of links and a spanning set of them, never the pairs. A pair counts
in the first table in which it meets.

Vectors that are null, zero, of null or non-finite components, or without label link with
nothing. Vectors of different length are not compared. Each row gets a row; repeated rows
are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common
from rivulet.llm.components import components

BITS = 16
#: Chance that a pair at the threshold meets in no table, if bits differ by the angle.
MISS = 1e-3
#: Number of the table in which the core meets, which comes first.
CORE = -1


def learn_rotation(sample: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """Directions (columns) whose signs make a code, for centred rows."""
    _, vectors = np.linalg.eigh(sample.T @ sample)
    turned, _ = np.linalg.qr(rng.normal(size=(vectors.shape[1],) * 2))
    projected = sample @ vectors
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(projected @ turned).T @ projected)
        turned = (left @ right).T
    return vectors @ turned


def tables_needed(distance: np.ndarray, threshold: float) -> np.ndarray:
    """Tables in which vectors at these distances from the mean must be entered; infinite where none suffice."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold))
    seen = np.divide(reach, distance, out=np.ones_like(distance), where=distance > reach)
    meet = (1 - np.arcsin(seen) / np.pi) ** BITS
    need = np.ceil(np.log(MISS) / np.log1p(-np.minimum(meet, 1 - 1e-12)))
    return np.where(distance > reach, need, np.inf)


class Coder:
    """Codes of unit vectors of one dimension: at least ``tables`` and at most ``most`` numbers of ``BITS`` bits.

    There are as many as 99 in 100 of the sample need, as far as ``most`` allows.
    """

    def __init__(self, sample: np.ndarray, tables: int, most: int, threshold: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.threshold = sample.mean(axis=0), threshold
        need = np.sort(tables_needed(np.linalg.norm(sample - self.mean, axis=1), threshold))
        need = need[: max(1, len(need) * 99 // 100)]
        self.tables = int(max(tables, need[need <= most].max(initial=tables)))
        bits, made = self.tables * BITS, []
        while sum(m.shape[1] for m in made) < bits:
            rounds = 30 if len(made) * sample.shape[1] < tables * BITS else 5
            made.append(learn_rotation(sample - self.mean, rng, rounds))
        self.directions = np.concatenate(made, axis=1)[:, :bits]

    def codes(self, unit: np.ndarray) -> np.ndarray:
        bits = (unit - self.mean) @ self.directions > 0
        return (bits.reshape(len(unit), -1, BITS) @ (1 << np.arange(BITS)) - (1 << BITS - 1)).astype(np.int16)

    def entered(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In how many tables each vector is entered, and whether it is of the core."""
        need = tables_needed(np.linalg.norm(unit - self.mean, axis=1), self.threshold)
        return np.minimum(need, self.tables).astype(int), need > self.tables


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.98,
    tables: int = 12,
    sample_rows: int = 10_000,
    block: int = 1024,
    most_tables: int = 384,
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Rotations are learned on at most ``sample_rows`` vectors, those least by a hash. A
    vector is entered in no more than ``most_tables`` tables.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    sound = (
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
        & F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
    )
    valid = rows.where(sound)
    entries = common.written(
        valid.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors"
    )
    sample = entries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample_rows).collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r.vector), []).append(r.vector)
    few = len(sample) <= min(block, sample_rows - 1)
    coders = {
        n: Coder(_unit(np.array(v)), tables, most_tables, threshold) for n, v in sorted(by_size.items()) if not few
    }

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                vectors = part.column("vector").to_pylist()
                codes, core = [np.empty(0, np.int16)] * len(vectors), [True] * len(vectors)
                for n, coder in coders.items():
                    own = [i for i, v in enumerate(vectors) if len(v) == n]
                    if own:
                        unit = _unit(np.array([vectors[i] for i in own]))
                        for i, code, size, near in zip(own, coder.codes(unit), *coder.entered(unit), strict=True):
                            codes[i], core[i] = code[:size], bool(near)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(codes, pa.list_(pa.int16())), pa.array(core, pa.bool_())],
                    [*part.schema.names, "code", "parts", "core"],
                )

    coded = common.written(
        entries.mapInArrow(
            encode,
            "label int, vector array<double>, rep long, copies long, code binary, parts array<short>, core boolean",
        ),
        "codes",
    )
    dim = F.size("vector").alias("dim")
    slots = coded.select("rep", "label", dim, F.posexplode("parts").alias("number", "value")).unionByName(
        coded.where("core").select(
            "rep", "label", dim, F.lit(CORE).alias("number"), F.lit(0).cast("short").alias("value")
        )
    )
    sizes = slots.groupBy("label", "dim", "number", "value").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = (
        slots.join(sizes, ["label", "dim", "number", "value"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .join(coded.select("rep", "vector", "copies", "code", "core"), "rep")
        # Of the code, the parts of earlier tables; two bytes each.
        .withColumn("code", F.substring("code", F.lit(1), F.greatest(F.lit(0), 2 * F.col("number"))))
        .select("label", "dim", "number", "value", "low", "high", "block", "rep", "copies", "code", "core", "vector")
    )
    bucket = ["label", "dim", "number", "value", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for batch in batches for row in batch.to_pylist())
        for key, group in groupby(every, key=itemgetter(*bucket)):
            found = _links(list(group), key[2], key[4] == key[5], threshold)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["a", "b", "links"]
                )

    spread = dealt.repartition(common.partitions(spark), *bucket).sortWithinPartitions(*bucket, "rep")
    links = common.written(spread.mapInArrow(compare, "a long, b long, links long"), "links")
    joined = components(links.where("b is not null").select("a", "b"))
    sums = links.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    per_entry = (
        entries.join(sums, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "vector",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return rows.join(per_entry, ["label", "vector"], "left").select(
        "vec_id",
        F.when(sound, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(sound, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        F.when(sound, F.col("component_id") == F.col("vec_id")).otherwise(F.lit(True)).alias("kept"),
    )


def _links(rows: list[dict], number: int, same_block: bool, threshold: float) -> list[tuple]:
    """Sums of links per entry, and links that span what is connected here."""
    unit = _unit(np.array([r["vector"] for r in rows]))
    core = np.array([r["core"] for r in rows])
    copies = np.array([r["copies"] for r in rows])
    rep = [r["rep"] for r in rows]
    block = np.array([r["block"] for r in rows])
    first = np.arange(len(rows)) if same_block else np.flatnonzero(block == block.min())
    second = first if same_block else np.flatnonzero(block != block.min())
    if not len(second):
        return []
    close = unit[first] @ unit[second].T >= threshold
    if same_block:
        np.fill_diagonal(close, False)
    if number != CORE:
        close &= ~(core[first][:, None] & core[second][None, :])
        code = np.frombuffer(b"".join(r["code"] for r in rows), np.int16).reshape(len(rows), number)
        i, j = np.nonzero(close)
        for earlier in range(number):
            new = code[first[i], earlier] != code[second[j], earlier]
            close[i[~new], j[~new]] = False
            i, j = i[new], j[new]
    sums = np.zeros(len(rows), dtype=np.int64)
    sums[first] += close @ copies[second]
    if not same_block:
        sums[second] += close.T @ copies[first]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    found: list[tuple] = [(rep[i], None, int(n)) for i, n in enumerate(sums) if n]
    for i, j in zip(*np.nonzero(close), strict=True):
        x, y = root(int(first[i])), root(int(second[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            found.append((rep[x], rep[y], None))
    return found
