"""Vector codes from codebooks of integer parts, found by equal-average search.

Vectors become integers and are cut into equal consecutive parts; each part position has a
codebook of its own. Entries are sorted by the sum of their components. The search starts
at a part's own sum and goes outward on both sides: the squared gap between two sums, over
the number of components, never exceeds the squared distance of the vectors, so it ends
where that bound strictly exceeds the best distance found. Results are exact, ties included.

A round assigns all parts and sums them up per entry within each task, so that only one
row per task and entry is shuffled. The codebooks themselves, a fixed number of integers,
are all that reaches the driver.

All arithmetic is in integers: in 64 bits where these suffice, without bound elsewhere.

Vectors that are null or hold null or non-finite components have no row. Rows without id
are encoded, but start no codebook; of rows that repeat an id the least vector counts as
its start. The codebooks have the dimension of the least id whose vector can be cut;
vectors of other lengths have a row with null code and error. Errors beyond 64 bits stand
at the greatest long. Of an empty table there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common

_MOST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """``entries`` by part, entry and position: integers, of Python's own kind if they are large."""

    entries: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.entries)

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for x in self.entries.ravel().tolist()).encode()).hexdigest()


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * value)`` of finite doubles, exactly if ``scale`` is a power of two."""
    if not values.size or np.abs(values).max() < (1 << 52) / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = [int(x) * scale if abs(x) >= 1 << 53 else int(np.floor(x * scale)) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _fitting(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in 64 bits if squared gaps of sums fit in them, else in Python's integers."""
    largest = max((int(np.abs(x).max()) for x in (points, book) if x.size), default=0)
    kind = np.int64 if 2 * largest * max(1, points.shape[1]) < 1 << 31 else object
    return points.astype(kind), book.astype(kind)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for each row, the lower one of equals, and the squared distance."""
    points, book = _fitting(points, book)
    sums, own = book.sum(axis=1), points.sum(axis=1)
    order = np.array(sorted(range(len(book)), key=lambda k: (sums[k], k)), dtype=np.int64)
    sums = sums[order]
    right = np.searchsorted(sums, own, side="left")
    left = right - 1
    index, best = np.full(len(points), -1), np.zeros(len(points), points.dtype)
    open_rows = np.arange(len(points))
    while open_rows.size:
        lower, upper, here = left[open_rows], right[open_rows], own[open_rows]
        gap_low = here - sums[np.maximum(lower, 0)]
        gap_high = sums[np.minimum(upper, len(sums) - 1)] - here
        low = (lower >= 0) & ((upper >= len(sums)) | (gap_low <= gap_high))
        gap = np.where(low, gap_low, gap_high)
        bound = best[open_rows] * points.shape[1]
        on = ((lower >= 0) | (upper < len(sums))) & ((index[open_rows] < 0) | (gap * gap <= bound).astype(bool))
        open_rows, low = open_rows[on], low[on]
        entry = order[np.where(low, left[open_rows], np.minimum(right[open_rows], len(sums) - 1))]
        away = points[open_rows] - book[entry]
        distance = (away * away).sum(axis=1)
        was, at = best[open_rows], index[open_rows]
        better = (at < 0) | (distance < was).astype(bool) | ((distance == was).astype(bool) & (entry < at))
        best[open_rows[better]], index[open_rows[better]] = distance[better], entry[better]
        left[open_rows] -= low
        right[open_rows] += ~low
    return index, best


def _vectors(column: pa.Array, parts: int, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the length of the codebooks, and their parts as integers."""
    fits = column.value_lengths().to_numpy(zero_copy_only=False) == parts * width
    values = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
    return fits, whole_numbers(values, scale).reshape(fits.sum(), parts, width)


def _floors(total: list[int], n: int) -> list[int]:
    return [x // n for x in total]


def _moved(vectors: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """Each entry replaced by the floor of the mean of its parts; those without parts stay."""
    entries, parts, width = books.entries, books.parts, books.width
    size = entries.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), object)
        for batch in batches:
            _, points = _vectors(batch.column(0), parts, width, scale)
            for p in range(parts):
                index, _ = nearest(points[:, p], entries[p])
                found = points[:, p]
                if found.dtype != object and found.size and int(np.abs(found).max()) * len(found) >= 1 << 62:
                    found = found.astype(object)
                sub = np.zeros((size, width), found.dtype)
                np.add.at(sub, index, found)
                total[p] += sub.astype(object)
                count[p] += np.bincount(index, minlength=size)
        used = np.flatnonzero(count.ravel())
        rows = total.reshape(parts * size, width)[used]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(count.ravel()[used], pa.int64()),
                pa.array([",".join(map(str, row)) for row in rows.tolist()], pa.string()),
            ],
            ["slot", "n", "total"],
        )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = [sum(column) for column in zip(*(map(int, t.split(",")) for t in rows.total), strict=True)]
        mean = ",".join(map(str, _floors(total, int(rows.n.sum()))))
        return pd.DataFrame({"slot": [rows.slot.iloc[0]], "mean": [mean]})

    found = vectors.select("vector").mapInArrow(sums, "slot int, n long, total string")
    moved = entries.astype(object).reshape(parts * size, width)
    for row in found.groupBy("slot").applyInPandas(add, "slot int, mean string").collect():
        moved[row.slot] = [int(x) for x in row["mean"].split(",")]
    return Codebooks(moved.reshape(parts, size, width))


def _starts(vectors: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the vectors of the least ids, at most ``entries`` of them."""
    cut = vectors.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    first = cut.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").limit(1).collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    alike = cut.where(F.size("vector") == len(first[0].vector))
    ids = [r.vec_id for r in alike.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    rows = alike.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    found = np.array([r.vector for r in sorted(rows.collect(), key=lambda r: r.vec_id)], float)
    return Codebooks(whole_numbers(found, scale).reshape(len(ids), parts, -1).transpose(1, 0, 2))


def sound_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` of rows whose vector has finite components only."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))


def train_codebooks(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> Codebooks:
    """Codebooks of :func:`sound_vectors` rows; ``scale`` should be a power of two."""
    books = _starts(vectors, parts, entries, scale)
    if books.width:
        for _ in range(rounds):
            books = _moved(vectors, books, scale)
    return books


def assign_codes(vectors: DataFrame, books: Codebooks, scale: int = 4096) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of :func:`sound_vectors` rows."""
    parts, width, entries = books.parts, books.width, books.entries
    digits = max(2, len(f"{max(0, entries.shape[1] - 1):x}"))
    names = np.array([f"{k:0{digits}x}" for k in range(entries.shape[1])], dtype=object)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, points = _vectors(batch.column("vector"), parts, width, scale)
            codes = np.full(len(fits), None, object)
            errors = np.full(len(fits), None, object)
            if width and fits.any():
                found = [nearest(points[:, p], entries[p]) for p in range(parts)]
                text = names[found[0][0]]
                error = found[0][1].astype(object)
                for index, distance in found[1:]:
                    text = text + names[index]
                    error = error + distance.astype(object)
                codes[fits], errors[fits] = text, np.minimum(error, _MOST)
            columns = [pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), *columns], ["vec_id", "label", "code", "error"]
            )

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"vec_id long, label {kind}, code string, error long")


def compress_vectors(
    embeddings: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> DataFrame:
    """Per row: ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``."""
    vectors = common.written(sound_vectors(embeddings), "vectors")
    books = train_codebooks(vectors, parts, entries, rounds, scale)
    coded = common.written(assign_codes(vectors, books, scale), "codes")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(whole.isNotNull(), F.least(whole, F.lit(_MOST).cast("decimal(38,0)"))).cast("long").alias("label_error")
    )
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
