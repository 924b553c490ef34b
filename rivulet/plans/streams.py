"""Queries that run a stream or fill tables over the given events, and return what is there then.

The events go through in several files or batches, so that state is carried between them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.archive import to_parameter
from rivulet.session import shared_folder
from rivulet.sources import attributes, fixtures
from rivulet.streaming.enrich import finish_batch, lookup_stream
from rivulet.streaming.forecast import forecast_stream
from rivulet.streaming.neighbors import neighbor_mean_stream

# Spans of time, and files of each, which make one micro-batch.
_SPANS, _SPAN_FILES = 3, 4
_PAST_ALL = "timestamp'2100-01-01 00:00:00'"


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/replay-{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    """A database of its own in the shared folder, with the attribute tables."""
    name = f"replay_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    attributes.create_attribute_tables(spark, name)
    return name


def _spans(rows: DataFrame) -> list[DataFrame]:
    """Rows in spans of time, the earliest first."""
    low, high = rows.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    if low is None:
        return []
    span = F.least(F.expr(f"(unix_micros(timestamp) - {low}) * {_SPANS} div {high - low + 1}"), F.lit(_SPANS - 1))
    return [rows.where(span == i) for i in range(_SPANS)]


def _replayed(rows: DataFrame, closing: int = 0) -> DataFrame:
    """A stream of rows, one span of time after another, then ``closing`` rows that move the watermark past all."""
    folder = _folder(rows.sparkSession)
    last = rows.limit(1).withColumns({"timestamp": F.expr(_PAST_ALL), "sensorid": F.lit("closing")})
    # No other file may come first, as files are counted off in the order in which they were written.
    for part in _spans(rows) or [rows]:
        part.repartition(_SPAN_FILES).write.mode("append").parquet(folder)
    for _ in range(closing * _SPAN_FILES):
        last.write.mode("append").parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", _SPAN_FILES).parquet(folder)


def _at_once(rows: DataFrame) -> DataFrame:
    """A stream that has all rows in its first micro-batch."""
    folder = _folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(folder)


def _result(df: DataFrame, handle: Callable[[DataFrame, int], DataFrame] = lambda batch, _: batch) -> DataFrame:
    """All rows that a stream gives until its input is handled."""
    folder = _folder(df.sparkSession)

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        handle(batch, number).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        batch.unpersist()

    query = df.writeStream.foreachBatch(store).option("checkpointLocation", f"{folder}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(f"{folder}/rows").drop("batch")


def latest_parameters_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of latest values after batches that come in no order of time, merged in between."""
    database, updates = _database(spark), to_parameter(fixtures.updates(spark, sf_dir), keep=("update_id",))
    for number in range(5):
        own = updates.where(F.col("update_id") % 5 == (number * 3) % 5)
        attributes.record_updates(own, database, "replay", number, ["update_id"])
        attributes.merge_latest(spark, database, least=2)
    return attributes.latest_values(spark, database).drop("version")


def enrich_archive_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings against the archive and its snapshots, to which late updates were added."""
    database = _database(spark)
    updates = to_parameter(fixtures.updates(spark, sf_dir, joined=True), keep=("update_id",))
    for number in range(2):
        own = updates.where(F.col("update_id") % 2 == number)
        attributes.record_updates(own, database, "replay", number, ["update_id"])
        if number == 0:
            for row in own.selectExpr("date(timestamp) as day").distinct().where("day(day) % 10 = 0").orderBy("day").collect():
                attributes.make_snapshot(spark, database, row.day)
    return attributes.enrich_from_archive(fixtures.readings(spark, sf_dir, joined=True), database)


def enrich_stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that come after all updates, over state of three days and the archive."""
    database = _database(spark)
    updates = fixtures.updates(spark, sf_dir, joined=True).drop("update_id")
    readings = fixtures.readings(spark, sf_dir, joined=True).drop("reading_id")
    looked_up = lookup_stream(
        _replayed(readings), _at_once(updates), keep_buckets=3, initial_is_complete=False, pass_updates_on=True
    )

    def finish(batch: DataFrame, number: int) -> DataFrame:
        news = batch.where("parameter is not null").select("sensorid", "timestamp", "parameter", "value")
        attributes.record_updates(news, database, "replay", number)
        return finish_batch(batch, database)

    return _result(looked_up, finish)


def neighbor_mean_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell means from state that three micro-batches carry on."""
    readings = fixtures.cell_readings(spark, sf_dir).drop("reading_id")
    return _result(neighbor_mean_stream(_replayed(readings)))


def arima_forecast_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of every window, as the watermark closes it."""
    readings = fixtures.typed_readings(spark, sf_dir).drop("reading_id")
    return _result(forecast_stream(_replayed(readings, closing=2))).where("sensorid <> 'closing'")
