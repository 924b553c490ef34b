"""Reading and writing message topics.

A topic is a Kafka topic, a folder of files or a table. The transforms do not
depend on which: they read a string column ``value`` and write ``key`` and
``value``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Writer settings for Kafka, batch size in bytes and milliseconds to wait for a batch.
KAFKA_BATCH_OPTIONS = {"kafka.batch.size": "16384", "kafka.linger.ms": "1000"}


@dataclass(frozen=True)
class Topic:
    """Where messages are: ``kafka`` (name = topic), ``table`` (name = table),
    ``memory`` (name = query) or a file format (name = folder).
    """

    format: str
    name: str
    options: dict[str, str] = field(default_factory=dict)


# Where a message stands in its source: messages of one key are in this order.
ARRIVAL = "arrival"


def _kafka_arrival() -> Column:
    return F.struct("timestamp", "topic", "partition", "offset")


def _file_arrival(streaming: bool) -> Column:
    """By time and name of the file, then by place in it.

    Within the block of a file that a task reads rows are numbered as they come. A stream
    cannot number them; the tables do when they take a micro-batch in, before it is shuffled.
    """
    place = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "file_block_start")]
    return F.struct(*place, *([] if streaming else [F.monotonically_increasing_id().alias("row")]))


def end_mark(spark: SparkSession, topic: Topic, folder: str) -> datetime:
    """When the newest file of a folder or table was written, as of the first call for ``folder``.

    It is kept in ``folder``, so that a query that starts again goes on from its first start.
    """
    try:
        return spark.read.schema("mark timestamp").parquet(folder).first().mark
    except AnalysisException:
        pass
    if topic.format == "table":
        spark.catalog.refreshTable(topic.name)
        files = spark.table(topic.name).select(F.col("_metadata.file_modification_time").alias("time"))
    else:
        # Only the listing is read.
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(topic.name)
        files = files.select(F.col("modificationTime").alias("time"))
    newest = files.agg(F.coalesce(F.max("time"), F.timestamp_seconds(F.lit(0))).alias("mark"))
    newest.coalesce(1).write.parquet(folder)
    return spark.read.schema("mark timestamp").parquet(folder).first().mark


def read_topic(
    spark: SparkSession,
    topic: Topic,
    latest: bool = False,
    streaming: bool = True,
    start: str | None = None,
    arrival: bool = False,
) -> DataFrame:
    """Messages of a topic as a ``value`` column, from the first or only new ones.

    Files and tables have no end position of their own: ``start`` names a folder where the
    time of the newest file is kept when a query starts at the end, and ``latest`` then
    reads no file of before. Without such a folder the newest files only come first. With
    ``arrival`` a column of this name tells where each message stands.
    """
    reader = spark.readStream if streaming else spark.read
    wanted = [F.col("value").cast("string").alias("value")]
    if topic.format == "kafka":
        options = {"subscribe": topic.name, **topic.options}
        if streaming:
            options.setdefault("startingOffsets", "latest" if latest else "earliest")
        source = reader.format("kafka").options(**options).load()
        return source.select(*wanted, *([_kafka_arrival().alias(ARRIVAL)] if arrival else []))
    options = dict(topic.options)
    if topic.format == "table":
        source = reader.options(**options).table(topic.name)
    else:
        if streaming and latest and not start:
            options.setdefault("latestFirst", "true")
        reader = reader.format(topic.format).options(**options)
        if topic.format != "text":
            reader = reader.schema("key string, value string")
        source = reader.load(topic.name)
    if latest and start:
        source = source.where(F.col("_metadata.file_modification_time") > F.lit(end_mark(spark, topic, start)))
    return source.select(*wanted, *([_file_arrival(streaming).alias(ARRIVAL)] if arrival else []))


def write_topic(
    messages: DataFrame,
    topic: Topic,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start a query that writes ``key`` and ``value`` to a topic.

    File sinks write every message exactly once. Kafka gets every message at
    least once, and readers drop repeats by the keys of the archive tables.
    """
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    if query_name:
        writer = writer.queryName(query_name)
    if topic.format == "table":
        return writer.options(**topic.options).toTable(topic.name)
    if topic.format == "memory":
        return writer.format("memory").queryName(topic.name).start()
    if topic.format == "kafka":
        options = {**KAFKA_BATCH_OPTIONS, "topic": topic.name, **topic.options}
        return writer.format("kafka").options(**options).start()
    return writer.format(topic.format).options(**topic.options).start(topic.name)
