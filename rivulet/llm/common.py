"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a folder of our own only where none is set, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="rivulet-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to a table in the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, df: DataFrame) -> str:
    """``name``, longer if ``df`` has such a column."""
    while name in df.columns:
        name += "_"
    return name


#: Bits of a row number that count rows of one file, and all bits of it; keys from ``FREE`` on are no ids.
_ROW_BITS, _NUMBER_BITS, FREE = 34, 61, 1 << 61


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number of its own for each row, the same in every scan.

    Rows of files have their place in them; other rows are written once.
    """
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        for seed in range(8):
            file = F.pmod(F.xxhash64("_metadata.file_path", F.lit(seed)), F.lit(1 << _NUMBER_BITS - _ROW_BITS))
            try:
                files = df.select(F.col("_metadata.file_path").alias("path"), file.alias("file")).distinct().collect()
                found = df.withColumn(name, F.shiftleft(file, _ROW_BITS).bitwiseOR(F.col("_metadata.row_index")))
            except AnalysisException:
                break
            if len({r.file for r in files}) == len(files):
                return found
    return written(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def own_ids(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with a ``key`` for each row, the same in every scan and never null.

    The first row of each ``doc_id`` has this id, so keys of these are in order of ids
    (where ids reach beyond ``FREE``, a rank takes their place). All other rows have keys
    beyond: first those that repeat an id, then those without.
    """
    number, first, place = (fresh(n, documents) for n in ("_number", "_first", "_place"))
    rows = numbered(documents, number)
    doc = F.col("doc_id").cast("long")
    beyond, last = F.col(number) + F.lit(FREE), F.col(number) + F.lit(2 * FREE)
    each = rows.where(doc.isNotNull()).groupBy(doc.alias(key)).agg(F.min(number).alias(first), F.count("*").alias("n"))
    each = written(each, "ids")
    low, high = each.agg(F.min(key), F.max(key)).first()
    wide = low is not None and (low <= -FREE or high >= FREE)
    if wide:
        each = written(each.orderBy(key).withColumn(place, F.monotonically_increasing_id()), "places")
    else:
        each = each.where("n > 1").withColumn(place, F.col(key))
        if each.isEmpty():
            return rows.withColumn(key, F.coalesce(doc, last)).drop(number)
    with_id = rows.where(doc.isNotNull()).withColumn(key, doc).join(each.drop("n"), key, "left")
    own = F.when(F.col(first).isNull(), F.col(key)).when(F.col(first) == F.col(number), F.col(place)).otherwise(beyond)
    with_id = with_id.select(*(F.col(f"`{c}`") for c in documents.columns), own.alias(key))
    return with_id.unionByName(rows.where(doc.isNull()).withColumn(key, last).drop(number))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_blocks(
    batches: Iterator[pa.RecordBatch], max_rows: int = 4096, max_bytes: int = 8 << 20
) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts (null: empty) of two-column batches, in blocks of bounded size.

    A text longer than ``max_bytes`` makes a block of its own.
    """
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        block, size, first = [], 0, 0
        for i in range(len(keys)):
            text = texts[i].as_py() or ""
            if block and (len(block) >= max_rows or size + len(text) > max_bytes):
                yield keys[first:i], block
                block, size, first = [], 0, i
            block.append(text)
            size += len(text)
        if block:
            yield keys[first:], block


def binary_column(values: bytes | memoryview, offsets) -> pa.Array:
    """A binary column from one buffer and its int32 offsets."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    )
