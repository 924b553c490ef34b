"""Benchmark passages in training documents, by a distributed positional inverted index.

The index is a table of postings: term, document, positions. Only terms of benchmark
windows can matter, and of a window's postings only those in documents that hold both its
two rarest terms, so no others are stored. Matching starts from the rarest term: its
positions, less its place in the window, are the starts at which the window may stand.
Each further term, by rising frequency, keeps the starts at which it fits too. Those left
are exact phrase matches. With a width, a proximity match is an occurrence of the rarest
term that has every other term of the window within that many words, in any order.

Words are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count
as a-z. Null and empty texts have no words. Repeated rows are matched each by itself. Items
without words have no window; items without id mark words but are not listed. Empty tables
give empty results; with an empty benchmark no document is contaminated.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_INDEX = "row long, doc_id long, n_words long, term string, positions array<int>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def item_windows(items: DataFrame, length: int = 10) -> DataFrame:
    """The windows of ``length`` consecutive words; a shorter item is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [w.decode() for w in words_of(text or "")]
                if words:
                    size = min(length, len(words))
                    rows += [(item, words[i : i + size]) for i in range(len(words) - size + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string()))],
                ["item_id", "words"],
            )

    plain = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    return plain.mapInArrow(cut, "item_id long, words array<string>")


def document_frequencies(documents: DataFrame, terms: list[str]) -> dict[str, int]:
    """In how many documents each of the given terms occurs, counted over all documents."""
    wanted = {t.encode() for t in terms}

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(wanted.intersection(words_of(text.as_py() or "")))
        yield pa.RecordBatch.from_arrays(
            [pa.array([t.decode() for t in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["term", "docs"],
        )

    counted = documents.select("text").mapInArrow(count_terms, "term string, docs long")
    rows = counted.groupBy("term").agg(F.sum("docs").alias("docs")).collect()
    return {r.term: r.docs for r in rows}


def build_index(documents: DataFrame, ranked: list[list[str]]) -> DataFrame:
    """Postings of the windows' terms, and one row per document that has no term but its word count.

    ``documents`` has ``row``, ``doc_id`` and ``text``; ``ranked`` holds the windows as their terms by rising frequency.
    """
    by_rarest: dict[bytes, list[tuple[bytes, list[bytes]]]] = {}
    for window in ranked:
        first, *rest = [t.encode() for t in window]
        by_rarest.setdefault(first, []).append((rest[0] if rest else first, [first, *rest]))
    rarest = set(by_rarest)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in common.text_blocks(batches, max_rows=1024):
            rows: list[tuple] = []
            for own, text in zip(ids, block, strict=True):
                words, number, doc_id = words_of(text), own["row"], own["doc_id"]
                rows.append((number, doc_id, len(words), None, None))
                if found := rarest.intersection(words):
                    there = set(words)
                    wanted = {t for f in found for second, terms in by_rarest[f] if second in there for t in terms}
                    places: dict[bytes, list[int]] = {t: [] for t in wanted & there}
                    for at, word in enumerate(words) if places else ():
                        if word in places:
                            places[word].append(at)
                    rows += [(number, doc_id, None, t.decode(), at) for t, at in places.items()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["row", "doc_id", "n_words", "term", "positions"],
            )

    texts = documents.select(F.struct("row", F.col("doc_id").cast("long").alias("doc_id")).alias("own"), "text")
    return common.written(texts.mapInArrow(post, _INDEX), "postings")


def match_windows(index: DataFrame, windows: DataFrame, width: int | None = None) -> DataFrame:
    """Matches of windows: ``row``, ``item_id``, ``starts`` and ``length``.

    ``windows`` has ``item_id`` and ``terms``, structs of ``term`` and ``place`` by rising
    frequency. Without ``width`` starts are those of exact phrases, otherwise places of the
    rarest term that have all others within ``width`` words.
    """
    postings = index.where(F.col("term").isNotNull()).select("row", "term", "positions")
    keyed = windows.withColumn("window", F.xxhash64("item_id", "terms"))

    def shifted(entry: Column) -> Column:
        return F.transform("positions", lambda p: p - entry["place"]) if width is None else F.col("positions")

    def both(starts: Column, other: Column) -> Column:
        if width is None:
            return F.array_intersect(starts, other)
        return F.filter(starts, lambda p: F.exists(other, lambda q: F.abs(q - p) <= width))

    first = F.element_at("terms", 1)
    found = (
        keyed.withColumn("term", first["term"])
        .join(postings, "term")
        .select("row", "item_id", "window", "terms", shifted(first).alias("starts"))
    )
    second = F.try_element_at("terms", F.lit(2))
    paired = (
        found.where(F.size("terms") > 1)
        .withColumn("term", second["term"])
        .join(postings, ["term", "row"])
        .withColumn("starts", both(F.col("starts"), shifted(second)))
        .where(F.size("starts") > 0)
        .select("row", "item_id", "window", "terms", "starts")
    )
    rest = (
        paired.where(F.size("terms") > 2)
        .withColumn("entry", F.explode(F.slice("terms", 3, F.size("terms") - 2)))
        .withColumn("term", F.col("entry.term"))
        .join(postings, ["term", "row"])
        .withColumn("starts", both(F.col("starts"), shifted(F.col("entry"))))
        .where(F.size("starts") > 0)
        .groupBy("row", "item_id", "window")
        .agg(
            F.collect_list("starts").alias("each"),
            F.count(F.lit(1)).alias("n"),
            F.first(F.size("terms")).alias("length"),
        )
        .where(F.col("n") == F.col("length") - 2)
        .select(
            "row",
            "item_id",
            F.aggregate("each", F.element_at("each", 1), F.array_intersect).alias("starts"),
            "length",
        )
    )
    short = (
        found.where(F.size("terms") == 1)
        .unionByName(paired.where(F.size("terms") == 2))
        .select("row", "item_id", "starts", F.size("terms").alias("length"))
    )
    return rest.unionByName(short).where(F.size("starts") > 0)


def ranked_windows(windows: DataFrame, frequency: dict[str, int]) -> tuple[DataFrame, list[list[str]]]:
    """Distinct windows with their terms by rising frequency; windows with a term no document has go."""
    spark = windows.sparkSession
    rows, ranked = [], set()
    for r in windows.distinct().collect():
        if all(w in frequency for w in r["words"]):
            places = sorted(enumerate(r["words"]), key=lambda x: (frequency[x[1]], x[1], x[0]))
            rows.append((r["item_id"], [(w, i) for i, w in places]))
            ranked.add(tuple(w for _, w in places))
    schema = "item_id long, terms array<struct<term: string, place: int>>"
    return spark.createDataFrame(rows, schema), sorted(map(list, ranked))


def find_contamination(
    documents: DataFrame,
    items: DataFrame,
    length: int = 10,
    width: int | None = None,
    max_item_words: int = 500_000,
    max_item_bytes: int = 8 << 20,
) -> tuple[DataFrame, DataFrame]:
    """The documents (``row``, ``doc_id``, ``n_words``) and the matches of item windows in them.

    The windows' terms go to every task. Items of more than ``max_item_words`` words or
    ``max_item_bytes`` bytes in all are taken in slices of about that size, each with an index
    of its own; an item is in one slice. Rows are numbered once for all slices.
    """
    plain = items.select("item_id", F.col("text"))
    size = plain.agg(F.sum(F.size(F.split("text", _BREAK))).alias("words"), F.sum(F.octet_length("text")).alias("bytes"))
    total = size.first()
    slices = 1 + max((total["words"] or 0) // max_item_words, (total["bytes"] or 0) // max_item_bytes)
    if slices == 1:  # the documents are numbered in one scan only
        texts = documents.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    else:
        number = common.fresh("_row", documents)
        texts = common.numbered(documents, number).select(F.col(number).alias("row"), "doc_id", "text")
    heads, matches = None, None
    for number in range(slices):
        own = plain.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == number) if slices > 1 else plain
        windows = common.written(item_windows(own, length).distinct(), "windows")
        terms = [r[0] for r in windows.select(F.explode("words")).distinct().collect()]
        usable, ranked = ranked_windows(windows, document_frequencies(texts, terms))
        index = build_index(texts, ranked)
        found = match_windows(index, usable, width)
        heads = index.where(F.col("term").isNull()).select("row", "doc_id", "n_words") if heads is None else heads
        matches = found if matches is None else matches.unionByName(found)
    return heads, matches


def contamination_report(documents: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """Per row of ``documents``: words, words hit by benchmark windows, and the items that occur."""
    heads, matches = find_contamination(documents, items, length)
    each = F.transform("starts", lambda s: F.struct(s.alias("first"), (s + F.col("length")).alias("end")))
    spans = F.array_sort(F.flatten(F.collect_set(each)))
    hit = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["first"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    items_hit = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    per_row = matches.groupBy("row").agg(hit.cast("long").alias("n_hit"), items_hit.alias("items"))
    none = F.array().cast("array<string>")
    return heads.join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """``documents`` without the rows that hold a window of an item."""
    key = common.fresh("_key", documents)
    own = common.own_ids(documents, key)
    heads, matches = find_contamination(own.select(F.col(key).alias("doc_id"), "text"), items, length)
    hit = heads.join(matches.select("row").distinct(), "row", "left_semi").select(F.col("doc_id").alias(key))
    return own.join(hit, key, "left_anti").select(*(F.col(f"`{c}`") for c in documents.columns))
