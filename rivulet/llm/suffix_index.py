"""Long repeated byte strings, by a logarithmic family of sparse suffix arrays.

A suffix array here lists the suffixes that start at anchors: of the 32-byte strings in
each window of ``LENGTH`` bytes, the one of least hash. Equal windows have their anchor at
the same place, so every window is found through one suffix. Entries are in the order of
their first 32 bytes' fingerprint, then of the fingerprint of the context, which is all the
windows that share the anchor; text order would need the bytes in every entry.

A new batch of documents gets such an array and is merge-scanned against the arrays of the
existing levels: equal contexts are matches of all their windows, and where one anchor has
several contexts their windows are compared byte by byte. The batch's own new contexts
become a level of size one; two levels of equal size merge into one of twice the size, so
there are at most logarithmically many.

Batches come in rising order of ids. Null and empty texts have no windows. Rows without id
are left whole. Rows that repeat a ``doc_id`` must repeat its text; each gets a row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm import common

LENGTH, GRAM = 100, 32
#: Contexts of one anchor that one task compares; more are dealt by the windows' places.
MANY, PARTS = 20_000, 32
_RANDOM = np.random.default_rng(100)
_BYTE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_ENTRY = "gram long, context long, doc long, first int, windows int, sure boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


class Anchors:
    """Finds the anchors of texts; keeps the powers that fingerprints need."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", _STEP), ("inverses", _INVERSE)):
                steps = np.full(2 * n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints of grams and contexts, first windows and numbers of windows."""
        n = len(data)
        if n < LENGTH:
            none = np.empty(0, dtype=np.int64)
            return none, none, none, none
        self._grow(n + 1)
        values = _BYTE[np.frombuffer(data, dtype=np.uint8)]
        grams, size = values, 1
        while size < GRAM:
            grams = grams[:-size] * self.powers[size] + grams[size:]
            size *= 2
        grams = _mix(grams)
        low = np.uint64(0xFFFFFFFF)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span, size = LENGTH - GRAM + 1, 1
        while 2 * size <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
        at = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        windows = np.diff(np.append(first, len(at)))
        anchor, end = at[first], first + windows + LENGTH - 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.inverses[:n], out=sums[1:])
        whole = (sums[end] - sums[first]) * self.powers[first]
        context = _mix(whole + (anchor - first).astype(np.uint64) * _STEP + (end - first).astype(np.uint64))
        return grams[anchor].view(np.int64), context.view(np.int64), first, windows


def suffix_array(documents: DataFrame) -> DataFrame:
    """Entries of the documents' anchored suffixes, not yet in order.

    Contexts that a block of documents repeats are found where the block is read. They
    become a few entries of joined windows, ``sure`` to be repeats, under fingerprints of
    their own, so copies and periodic texts do not meet in one task.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for ids, block in common.text_blocks(batches, max_rows=4096, max_bytes=12 << 20):
            found = [anchors.of(text.encode()) for text in block]
            gram, context, first, windows = (np.concatenate([f[k] for f in found]) for k in range(4))
            doc = np.repeat(np.array(ids, dtype=np.int64), [len(f[0]) for f in found])
            order = np.lexsort((first, doc, context, gram))
            gram, context, doc, first, windows = (c[order] for c in (gram, context, doc, first, windows))
            new = np.ones(len(gram), dtype=bool)
            new[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            sure = ~new & ((doc != doc[head]) | (first != first[head]))
            spans = _joined(doc[sure], first[sure], windows[sure])
            own = _mix((spans[0].view(np.uint64) + np.uint64(1)) * _STEP + spans[1].view(np.uint64)).view(np.int64)
            columns = [
                np.concatenate([c[~sure], x])
                for c, x in zip((gram, context, doc, first, windows), (own, own, *spans), strict=True)
            ]
            columns += [np.concatenate([np.zeros((~sure).sum(), bool), np.ones(len(own), bool)])]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["gram", "context", "doc", "first", "windows", "sure"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return texts.mapInArrow(extract, _ENTRY)


def _joined(doc: np.ndarray, first: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of a document as one where they meet."""
    if not len(doc):
        return doc, first, windows
    order = np.lexsort((first, doc))
    doc, first, windows = doc[order], first[order], windows[order]
    start = np.ones(len(doc), dtype=bool)
    start[1:] = (doc[1:] != doc[:-1]) | (first[1:] > first[:-1] + windows[:-1])
    at = np.flatnonzero(start)
    ends = np.maximum.reduceat(first + windows, at)
    return doc[at], first[at], ends - first[at]


class SuffixIndex:
    """Levels of suffix arrays over the documents added so far."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame, documents: DataFrame, keep: bool = True) -> DataFrame:
        """Repeats in ``batch`` of strings that start earlier: ``doc``, ``start``, ``end``.

        ``documents`` holds the texts of this and all earlier batches. With ``keep`` false
        the batch is scanned but not indexed.
        """
        entries = suffix_array(batch).withColumn("new", F.lit(True))
        for _, level in self.levels:
            entries = entries.unionByName(level.withColumns({"sure": F.lit(False), "new": F.lit(False)}))
        scanned = self._scan(entries)
        if not keep:
            scanned = scanned.where("repeated or contested")
        scanned = common.written(scanned, "scan")
        if keep:
            run = scanned.where("new and not repeated").select("gram", "context", "doc", "first", "windows")
            self._store(1, run)
        whole = scanned.where("new and repeated").select(
            "doc", F.col("first").alias("start"), (F.col("first") + F.col("windows") + LENGTH - 1).alias("end")
        )
        return whole.unionByName(self._compare(scanned.where("contested and not repeated"), documents))

    @staticmethod
    def _scan(entries: DataFrame) -> DataFrame:
        """Entries merged in order: ``repeated`` by context; ``contested`` if the anchor has other contexts."""
        ranked = Window.partitionBy("gram", "context").orderBy("doc", "first")
        anchor = Window.partitionBy("gram")
        return (
            entries.repartition(common.partitions(entries.sparkSession), "gram")
            .withColumn("earliest", F.first(F.struct("doc", "first")).over(ranked))
            .withColumn("repeated", F.col("sure") | (F.col("earliest") != F.struct("doc", "first")))
            .withColumn(
                "contested",
                (F.min("context").over(anchor) != F.max("context").over(anchor)) & F.max("new").over(anchor),
            )
            .withColumn("size", F.sum((~F.col("repeated")).cast("int")).over(anchor))
            .drop("earliest")
        )

    @staticmethod
    def _compare(contested: DataFrame, documents: DataFrame) -> DataFrame:
        """Windows of new contexts that an earlier context of the same anchor holds too."""
        per_doc = contested.groupBy("doc").agg(
            F.collect_list(F.struct("first", "windows", "gram", "new", "size")).alias("entries")
        )
        texts = documents.select(F.col("doc_id").cast("long").alias("doc"), "text").where("text is not null")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
                    rows = batch.column(2)[i].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r["gram"] for r in rows], pa.int64()),
                            pa.array([doc] * len(rows), pa.int64()),
                            pa.array([r["first"] for r in rows], pa.int32()),
                            pa.array([r["new"] for r in rows], pa.bool_()),
                            pa.array([PARTS if r["size"] > MANY else 1 for r in rows], pa.int32()),
                            pa.array([text[r["first"] : r["first"] + r["windows"] + LENGTH - 1] for r in rows], pa.binary()),
                        ],
                        ["gram", "doc", "first", "new", "parts", "bytes"],
                    )

        joined = texts.join(per_doc, "doc").dropDuplicates(["doc"]).select("doc", "text", "entries")
        cuts = joined.mapInArrow(cut, "gram long, doc long, first int, new boolean, parts int, bytes binary")
        dealt = cuts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            found: list[tuple[int, int, int]] = []
            for (_, part), group in groupby(rows, key=lambda r: (r[0], r[1])):
                seen: set[bytes] = set()
                for _, _, doc, first, new, parts, data in group:
                    start = None
                    for k in range(len(data) - LENGTH + 1):
                        if parts > 1 and zlib.crc32(data[k : k + LENGTH]) % parts != part:
                            continue
                        window = data[k : k + LENGTH]
                        if window not in seen:
                            seen.add(window)
                        elif new:
                            if start is not None and start[1] == first + k + LENGTH - 1:
                                start[1] += 1
                            else:
                                if start is not None:
                                    found.append((doc, *start))
                                start = [first + k, first + k + LENGTH]
                    if start is not None:
                        found.append((doc, *start))
                if len(found) > 10_000:
                    yield _spans(found)
                    found = []
            yield _spans(found)

        spread = dealt.repartition(common.partitions(documents.sparkSession), "gram", "part")
        ordered = spread.sortWithinPartitions("gram", "part", "doc", "first")
        return ordered.select("gram", "part", "doc", "first", "new", "parts", "bytes").mapInArrow(
            compare, "doc long, start int, end int"
        )

    def _store(self, size: int, run: DataFrame) -> None:
        """A new level; levels of equal size merge."""
        while any(s == size for s, _ in self.levels):
            other = next(level for s, level in self.levels if s == size)
            self.levels = [(s, level) for s, level in self.levels if s != size]
            both = run.unionByName(other).repartition(common.partitions(run.sparkSession), "gram")
            run = common.written(both.sortWithinPartitions("gram", "context", "doc", "first"), "level")
            size *= 2
        self.levels.append((size, run))


def _spans(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)],
        ["doc", "start", "end"],
    )


def repeated_spans(documents: DataFrame, batches: int = 2) -> DataFrame:
    """Per id with repeats: ``doc_id`` and ``spans``, its bytes to remove as sorted runs that may overlap."""
    ids = documents.select(F.col("doc_id").cast("double").alias("id"))
    cuts = ids.approxQuantile("id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    edges = [None, *sorted(set(map(int, cuts))), None]
    index, found = SuffixIndex(), None
    for number, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        own = documents
        own = own if low is None else own.where(F.col("doc_id") > low)
        own = own if high is None else own.where(F.col("doc_id") <= high)
        spans = index.add(own, documents, keep=number < len(edges) - 2)
        found = spans if found is None else found.unionByName(spans)
    ordered = F.array_sort(F.collect_list(F.struct("start", "end")))
    return found.groupBy(F.col("doc").alias("doc_id")).agg(ordered.alias("spans"))


def merged_runs(spans: list[dict] | None, n: int) -> list[tuple[int, int]]:
    """Sorted spans as maximal runs within ``n`` bytes."""
    runs: list[list[int]] = []
    for span in spans or ():
        start, end = span["start"], min(span["end"], n)
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        elif start < end:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def removal_report(documents: DataFrame, batches: int = 2) -> DataFrame:
    """Per row of ``documents``: its bytes, those removed, the runs removed and a hash of the rest."""
    spans = repeated_spans(documents, batches)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))

    def report(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = []
            for text, own in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = (text.as_py() or "").encode()
                runs = merged_runs(own.as_py(), len(data))
                rest = without(data, runs)
                rows.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, types, strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return texts.join(spans, "doc_id", "left").mapInArrow(
        report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs without the parts of characters that they only cut into."""
    kept = []
    for start, end in runs:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end < len(data) and end > start and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            kept.append((start, end))
    return kept


def remove_repeats(documents: DataFrame, batches: int = 2) -> DataFrame:
    """``documents`` with the repeats cut out of ``text`` in whole characters.

    ``n_chars``, where there is such a column, follows the text. Documents of which nothing
    is left go; null and empty texts stay as they are. Each row is a document of its own:
    first those of each id in order of ids, then those that repeat an id or have none.
    """
    key = common.fresh("_id", documents)
    keyed = common.own_ids(documents, key)
    spans = repeated_spans(keyed.select(F.col(key).alias("doc_id"), "text"), batches)
    schema, text = documents.schema, documents.columns.index("text")
    length = documents.columns.index("n_chars") if "n_chars" in documents.columns else None

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts, gone = [], []
            for value, own in zip(batch.column(text), batch.column(len(schema)), strict=True):
                value = value.as_py()
                if value and own.as_py():
                    data = value.encode()
                    rest = without(data, whole_characters(data, merged_runs(own.as_py(), len(data)))).decode()
                    texts.append(rest)
                    gone.append(not rest)
                else:
                    texts.append(value)
                    gone.append(False)
            columns = list(batch.columns[: len(schema)])
            columns[text] = pa.array(texts, columns[text].type)
            if length is not None:
                stated = columns[length].to_pylist()
                cut_here = [o is not None for o in batch.column(len(schema)).to_pylist()]
                new = [len(t or "") if c else n for t, c, n in zip(texts, cut_here, stated, strict=True)]
                columns[length] = pa.array(new, columns[length].type)
            left = pa.RecordBatch.from_arrays(columns, schema.names)
            yield left.filter(pa.array([not g for g in gone], pa.bool_()))

    own = spans.select(F.col("doc_id").alias(key), F.col("spans").alias(common.fresh("_spans", documents)))
    return keyed.join(own, key, "left").drop(key).mapInArrow(cut, schema)
