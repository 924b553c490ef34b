"""The five jobs: topics in, topics and tables out.

Each ``run_*`` function starts its streaming queries and returns them. Sources
and sinks are ``Topic`` values, so a job runs on Kafka, files or tables alike.
``checkpoint`` defaults to a folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators import archive, decode, encode
from rivulet.operators.enrich import fake_enrich
from rivulet.session import checkpoint_root, use_utc
from rivulet.sources import attributes, tables
from rivulet.sources.topics import ARRIVAL, Topic, read_topic, write_topic
from rivulet.streaming.enrich import finish_batch, lookup_stream
from rivulet.streaming.forecast import forecast_alerts_stream
from rivulet.streaming.neighbors import neighbor_alerts_stream
from rivulet.streaming.time import DISORDER, LATENESS, with_event_time

# Fixed value: the interval between checkpoints, in milliseconds.
CHECKPOINT_INTERVAL_MS = 600_000
# Days of versions that the enrichment job holds of each attribute.
KEEP_BUCKETS = 7


def _folder(spark: SparkSession, checkpoint: str | None, job: str) -> str:
    return checkpoint or f"{checkpoint_root(spark)}/{job}"


def _each_batch(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool,
    interval: str | None,
) -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def _archive(
    df: DataFrame, table: str, checkpoint: str, available_now: bool, interval: str | None, upsert: bool = False
) -> StreamingQuery:
    def store(batch: DataFrame, _batch_id: int) -> None:
        (tables.upsert_last_wins if upsert else tables.insert_first_wins)(batch, table, [ARRIVAL])

    return _each_batch(df, store, checkpoint, available_now, interval)


def run_enrichment(
    spark: SparkSession,
    raw: Topic,
    updates: Topic,
    rich: Topic,
    database: str,
    checkpoint: str | None = None,
    latest: bool = False,
    initialize: bool = False,
    from_archive: bool = False,
    cold_start: bool = False,
    wait_for_watermark: bool = False,
    keep_buckets: int = KEEP_BUCKETS,
    rejects: Topic | None = None,
    available_now: bool = False,
    interval: str | None = None,
) -> list[StreamingQuery]:
    """Raw packets and attribute updates in, enriched readings and archived updates out.

    A micro-batch stores its updates first: in the parameters table, the log of latest
    values and, every few days, snapshots. Attributes are kept as state, of each the newest
    ``keep_buckets`` days of versions; older readings are looked up in the archive.
    ``cold_start`` fills the state with the latest values, and ``from_archive`` keeps no
    state but looks everything up. ``rejects`` receives packets and entries that were not
    understood; the progress of the query counts them as the metric ``packets``.
    """
    use_utc(spark)
    folder = _folder(spark, checkpoint, "enrichment")
    if initialize:
        tables.create_tables(spark, database, tables=["parameters"])
    attributes.create_attribute_tables(spark, database)
    packets = read_topic(spark, raw, latest, start=f"{folder}/start-raw")
    readings = decode.parse_packets(packets, observe="packets")
    changes = decode.decode_update(read_topic(spark, updates, latest, start=f"{folder}/start-updates"))
    if from_archive:
        both = readings.select("sensorid", "timestamp", "rawValue").unionByName(
            changes.select("sensorid", "timestamp", "parameter", "value"), allowMissingColumns=True
        )
    else:
        initial = attributes.latest_values(spark, database) if cold_start else None
        if wait_for_watermark:
            readings, changes = with_event_time(readings), with_event_time(changes)
        both = lookup_stream(
            readings,
            changes,
            initial,
            wait_for_watermark,
            keep_buckets=keep_buckets,
            initial_is_complete=False,
            pass_updates_on=True,
        )

    def store_and_enrich(batch: DataFrame, batch_id: int) -> None:
        # The batch's updates first, so that its readings see them.
        batch = batch.persist()
        try:
            session = batch.sparkSession
            news = batch.where("parameter is not null").select("sensorid", "timestamp", "parameter", "value")
            attributes.record_updates(news, database, "enrichment", batch_id)
            attributes.merge_latest(session, database)
            attributes.snapshot_if_due(session, database, news)
            if from_archive:
                came = batch.where("parameter is null").drop("parameter", "value")
                enriched = attributes.enrich_from_archive(came, database)
            else:
                enriched = finish_batch(batch, database)
            _send(encode.encode_reading(enriched), rich, batch_id)
        finally:
            batch.unpersist()

    queries = [_each_batch(both, store_and_enrich, f"{folder}/rich", available_now, interval)]
    if rejects is not None:
        refused = decode.parse_rejects(packets).selectExpr("reason as key", "value")
        queries.append(write_topic(refused, rejects, f"{folder}/rejects", available_now, interval))
    return queries


def _send(messages: DataFrame, topic: Topic, batch_id: int) -> None:
    """Write one micro-batch to a topic. Tables and folders take a repeated batch's place."""
    if topic.format == "table":
        rows = messages.select("key", "value", F.lit(batch_id).cast("bigint").alias("batch"))
        if messages.sparkSession.catalog.tableExists(topic.name):
            messages.sparkSession.sql(
                f"INSERT OVERWRITE TABLE {topic.name} PARTITION (batch = {int(batch_id)}) SELECT key, value FROM {{rows}}",
                rows=rows,
            )
        else:
            rows.write.partitionBy("batch").saveAsTable(topic.name)
    elif topic.format == "kafka":
        messages.write.format("kafka").options(**{"topic": topic.name, **topic.options}).save()
    else:
        # A folder per batch, overwritten when the batch is repeated.
        target = f"{topic.name}/batch={batch_id}"
        messages.write.mode("overwrite").format(topic.format).options(**topic.options).save(target)


def run_storage(
    spark: SparkSession,
    rich: Topic,
    updates: Topic,
    alarms: Topic,
    database: str,
    checkpoint: str | None = None,
    latest: bool = False,
    fresh: bool = False,
    available_now: bool = False,
    interval: str | None = None,
) -> list[StreamingQuery]:
    """Archive readings, updates and alarms; the first write of a key wins, in the order of the topics."""
    use_utc(spark)
    folder = _folder(spark, checkpoint, "storage")
    tables.create_tables(spark, database, fresh)

    def arrivals(topic: Topic, table: str) -> DataFrame:
        return read_topic(spark, topic, latest, start=f"{folder}/start-{table}", arrival=True)

    keep = (ARRIVAL,)
    rows = {
        "measurements": archive.to_measurement(decode.decode_reading(arrivals(rich, "measurements"), keep), keep),
        "parameters": archive.to_parameter(decode.decode_update(arrivals(updates, "parameters"), keep), keep),
        "alarms": archive.to_alarm(decode.decode_alert(arrivals(alarms, "alarms"), keep), keep=keep),
    }
    return [
        _archive(df, f"{database}.{table}", f"{folder}/{table}", available_now, interval)
        for table, df in rows.items()
    ]


def run_neighbor(
    spark: SparkSession,
    rich: Topic,
    alarms: Topic,
    checkpoint: str | None = None,
    latest: bool = False,
    threshold: float = 10.0,
    available_now: bool = False,
    interval: str | None = None,
) -> list[StreamingQuery]:
    """Alarms for readings that deviate from the mean of their grid cell."""
    use_utc(spark)
    folder = _folder(spark, checkpoint, "neighbor")
    topic = read_topic(spark, rich, latest, start=f"{folder}/start-rich")
    readings = with_event_time(decode.decode_reading(topic), DISORDER)
    alerts = encode.encode_alert(neighbor_alerts_stream(readings, threshold))
    return [write_topic(alerts, alarms, f"{folder}/alarms", available_now, interval)]


def run_forecast(
    spark: SparkSession,
    rich: Topic,
    alarms: Topic,
    checkpoint: str | None = None,
    latest: bool = False,
    size: str = "2 hours",
    slide: str = "5 minutes",
    lateness: str = LATENESS,
    refire: bool = False,
    available_now: bool = False,
    interval: str | None = None,
) -> list[StreamingQuery]:
    """Alarms for readings outside the forecast interval of their window.

    With ``refire`` windows are evaluated early and again for every late reading.
    """
    use_utc(spark)
    folder = _folder(spark, checkpoint, "forecast")
    readings = decode.decode_reading(read_topic(spark, rich, latest, start=f"{folder}/start-rich"))
    alerts = forecast_alerts_stream(readings, refire, size=size, slide=slide, lateness=lateness)
    return [write_topic(encode.encode_alert(alerts), alarms, f"{folder}/alarms", available_now, interval)]


def run_passthrough(
    spark: SparkSession,
    raw: Topic,
    rich: Topic,
    database: str,
    checkpoint: str | None = None,
    latest: bool = True,
    seed: bool = False,
    fresh: bool = False,
    available_now: bool = False,
    interval: str | None = None,
) -> list[StreamingQuery]:
    """Readings with constant attributes, to a topic and to the measurements table."""
    use_utc(spark)
    folder = _folder(spark, checkpoint, "passthrough")
    if seed or fresh:
        tables.create_tables(spark, database, fresh)
    # The raw topic carries epoch seconds.
    topic = read_topic(spark, raw, latest, start=f"{folder}/start-raw", arrival=True)
    enriched = fake_enrich(decode.decode_reading(topic, (ARRIVAL,), seconds=True))

    rows, table = archive.to_measurement(enriched, (ARRIVAL,)), f"{database}.measurements"
    return [
        write_topic(encode.encode_reading(enriched), rich, f"{folder}/rich", available_now, interval),
        _archive(rows, table, f"{folder}/measurements", available_now, interval, upsert=True),
    ]
