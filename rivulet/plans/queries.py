"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import curves
from rivulet.functions.alerts import severity
from rivulet.functions.grid import geolocation_cell
from rivulet.operators import archive, decode, encode, enrich, forecast, neighbors, windows
from rivulet.plans import streams
from rivulet.schemas import UNKNOWN_CELL
from rivulet.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _report(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles and drop the zone of times, for comparison."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.dataType.typeName() == "double":
            column = F.round(column, digits)
        elif field.dataType.typeName() == "timestamp":
            column = column.cast("timestamp_ntz")
        out.append(column.alias(field.name))
    return df.select(*out)


# Decoding and encoding


@_query
def decode_raw_valid(spark, sf_dir):
    valid, _ = decode.decode_raw(fixtures.raw_packets(spark, sf_dir))
    return valid.select("event_id", "value")


@_query
def parse_senml(spark, sf_dir):
    packets = fixtures.raw_packets(spark, sf_dir)
    return _report(decode.parse_packets(packets, (decode.SENML,), keep=("event_id",)))


@_query
def parse_atlas(spark, sf_dir):
    packets = fixtures.raw_packets(spark, sf_dir)
    return _report(decode.parse_packets(packets, (decode.ATLAS,), keep=("event_id",)))


@_query
def parse_ttn(spark, sf_dir):
    packets = fixtures.raw_packets(spark, sf_dir)
    return _report(decode.parse_packets(packets, (decode.TTN,), keep=("event_id",)))


@_query
def parse_packets(spark, sf_dir):
    return _report(decode.parse_packets(fixtures.raw_packets(spark, sf_dir), keep=("event_id",)))


@_query
def parse_rejects(spark, sf_dir):
    rejects = decode.parse_rejects(fixtures.raw_packets(spark, sf_dir), keep=("event_id",))
    return rejects.select("event_id", "value", "reason")


@_query
def decode_reading(spark, sf_dir):
    return _report(decode.decode_reading(fixtures.reading_wire(spark, sf_dir), keep=("event_id",)))


@_query
def decode_update(spark, sf_dir):
    return _report(decode.decode_update(fixtures.update_wire(spark, sf_dir), keep=("event_id",)))


@_query
def decode_alert(spark, sf_dir):
    return _report(decode.decode_alert(fixtures.alert_wire(spark, sf_dir), keep=("event_id",)))


@_query
def encode_reading(spark, sf_dir):
    """Encoded readings read back, as number formats differ between engines."""
    readings = enrich.fake_enrich(fixtures.readings(spark, sf_dir))
    wire = encode.encode_reading(readings, keep=("reading_id",))
    return _report(decode.decode_reading(wire, keep=("reading_id", "key")))


@_query
def encode_update(spark, sf_dir):
    wire = encode.encode_update(fixtures.updates(spark, sf_dir), keep=("update_id",))
    return _report(decode.decode_update(wire, keep=("update_id", "key")))


@_query
def encode_alert(spark, sf_dir):
    wire = encode.encode_alert(fixtures.alerts(spark, sf_dir), keep=("event_id",))
    return _report(decode.decode_alert(wire, keep=("event_id", "key")))


@_query
def fake_enrich(spark, sf_dir):
    return _report(enrich.fake_enrich(fixtures.readings(spark, sf_dir)))


# Curves, cells and alert functions


@_query
def parse_curve(spark, sf_dir):
    texts = fixtures.updates(spark, sf_dir)
    points = texts.select("update_id", F.posexplode(curves.parse_curve(F.col("value"))).alias("pos", "point"))
    return _report(
        points.select("update_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "point.x", "point.y")
    )


@_query
def convert_values(spark, sf_dir):
    """The value of every event on a curve that its id selects."""
    id_text = "cast(event_id % 90 + {} as string)"
    values = fixtures.events(spark, sf_dir).selectExpr(
        "event_id",
        "value",
        "'[(1, 0),(50.5,' || " + id_text.format(1) + " || '),(300,' || " + id_text.format(200) + " || ')]' as curve",
    )
    converted = curves.interpolate(curves.parse_curve(F.col("curve")), F.col("value"))
    return _report(values.select("event_id", F.coalesce(converted, F.lit(-99.0)).alias("conValue")))


@_query
def assign_cell(spark, sf_dir):
    located = fixtures.updates(spark, sf_dir)
    cell = F.coalesce(geolocation_cell(F.col("value")), F.lit(UNKNOWN_CELL).cast("bigint"))
    return located.select("update_id", "value", cell.alias("gridCell"))


@_query
def alert_severity(spark, sf_dir):
    alerts = fixtures.alerts(spark, sf_dir)
    score = severity(F.col("value"), F.col("lower"), F.col("upper"))
    return _report(alerts.select("event_id", score.alias("severity")), 6)


@_query
def alert_messages(spark, sf_dir):
    alerts = fixtures.alerts(spark, sf_dir)
    return _report(archive.to_alarm(alerts, digits=6, keep=("event_id",)))


# Temporal enrichment


@_query
def enrich_asof(spark, sf_dir):
    return _report(
        enrich.enrich_asof(fixtures.readings(spark, sf_dir, joined=True), fixtures.updates(spark, sf_dir, joined=True), "update_id")
    )


@_query
def enrich_asof_split(spark, sf_dir):
    """The same result with every sensor cut into time buckets."""
    return _report(
        enrich.enrich_asof(
            fixtures.readings(spark, sf_dir, joined=True),
            fixtures.updates(spark, sf_dir, joined=True),
            "update_id",
            bucket_seconds=3_600,
        )
    )


@_query
def lookup_asof(spark, sf_dir):
    """Type and unit valid at every reading, as lookups for single parameters."""
    probes = fixtures.readings(spark, sf_dir, joined=True).select(
        "reading_id",
        "sensorid",
        "timestamp",
        F.explode(F.array(F.lit("type"), F.lit("unit"))).alias("parameter"),
    )
    return _report(enrich.lookup_asof(probes, fixtures.updates(spark, sf_dir, joined=True), "update_id"))


@_query
def latest_parameters(spark, sf_dir):
    return _report(enrich.latest_parameters(fixtures.updates(spark, sf_dir), "update_id"))


@_query
def param_versions(spark, sf_dir):
    return _report(enrich.param_versions(fixtures.updates(spark, sf_dir), "update_id"))


@_query
def pivot_attributes(spark, sf_dir):
    return enrich.pivot_attributes(fixtures.updates(spark, sf_dir), "update_id")


@_query
def latest_parameters_maintained(spark, sf_dir):
    return _report(streams.latest_parameters_maintained(spark, sf_dir))


@_query
def enrich_archive_pruned(spark, sf_dir):
    return _report(streams.enrich_archive_pruned(spark, sf_dir))


@_query
def enrich_stream_bounded(spark, sf_dir):
    return _report(streams.enrich_stream_bounded(spark, sf_dir))


# Neighbours


@_query
def cell_latest(spark, sf_dir):
    return _report(neighbors.cell_latest(fixtures.cell_readings(spark, sf_dir), "reading_id"))


@_query
def neighbor_mean(spark, sf_dir):
    return _report(neighbors.neighbor_mean(fixtures.cell_readings(spark, sf_dir), tie="reading_id"), 8)


@_query
def neighbor_mean_split(spark, sf_dir):
    """The same result with every sensor and cell cut into time buckets."""
    readings = fixtures.cell_readings(spark, sf_dir)
    return _report(neighbors.neighbor_mean(readings, tie="reading_id", bucket_seconds=3_600), 8)


@_query
def neighbor_mean_moving(spark, sf_dir):
    """Sensors that change their cell with every few readings."""
    readings = fixtures.cell_readings(spark, sf_dir)
    moving = readings.withColumn("gridCell", F.expr("(gridCell + reading_id div 50) % 7"))
    return _report(neighbors.neighbor_mean(moving, tie="reading_id"), 8)


@_query
def neighbor_alerts(spark, sf_dir):
    readings = fixtures.cell_readings(spark, sf_dir)
    return _report(neighbors.neighbor_alerts(readings, 60.0, tie="reading_id", keep=("reading_id",)), 8)


@_query
def neighbor_alerts_default(spark, sf_dir):
    readings = fixtures.cell_readings(spark, sf_dir)
    return _report(neighbors.neighbor_alerts(readings, tie="reading_id", keep=("reading_id",)), 8)


@_query
def neighbor_snapshot(spark, sf_dir):
    return _report(neighbors.neighbor_snapshot(fixtures.cell_readings(spark, sf_dir), tie="reading_id"), 8)


@_query
def neighbor_mean_streamed(spark, sf_dir):
    return _report(streams.neighbor_mean_streamed(spark, sf_dir), 8)


# Sliding windows and forecast


@_query
def sliding_counts(spark, sf_dir):
    return _report(windows.sliding_counts(fixtures.typed_readings(spark, sf_dir)))


@_query
def sliding_counts_by_sensor(spark, sf_dir):
    return _report(windows.sliding_counts(fixtures.cell_readings(spark, sf_dir)))


@_query
def window_history_last(spark, sf_dir):
    readings = fixtures.typed_readings(spark, sf_dir)
    return _report(windows.window_history_last(readings, tie="reading_id"))


@_query
def arima_forecast(spark, sf_dir):
    return _report(forecast.arima_forecast(fixtures.typed_readings(spark, sf_dir), tie="reading_id"))


@_query
def arima_forecast_half_day(spark, sf_dir):
    readings = fixtures.typed_readings(spark, sf_dir)
    return _report(forecast.arima_forecast(readings, "12 hours", "1 hour", tie="reading_id"))


@_query
def arima_alerts(spark, sf_dir):
    forecasts = forecast.arima_forecast(fixtures.typed_readings(spark, sf_dir), tie="reading_id")
    return _report(forecast.interval_alerts(forecasts, keep=("window_start",)))


@_query
def arima_forecast_streamed(spark, sf_dir):
    return _report(streams.arima_forecast_streamed(spark, sf_dir))


# Archive tables: every key arrives twice, with different contents


def _twice(df: DataFrame, changed: str, value) -> DataFrame:
    first = df.withColumn("arrival", F.lit(1))
    return first.unionByName(df.withColumn("arrival", F.lit(2)).withColumn(changed, value))


@_query
def store_measurements_first_wins(spark, sf_dir):
    """A batch of all readings twice, over a table that holds every third one."""
    readings = enrich.fake_enrich(fixtures.readings(spark, sf_dir))
    batch = archive.to_measurement(
        _twice(readings, "type", F.lit("LATE")), keep=("reading_id", "arrival")
    )
    stored = archive.to_measurement(
        readings.where("reading_id % 3 = 0").withColumn("type", F.lit("STORED")), keep=("reading_id",)
    )
    added = archive.new_rows(batch, stored, archive.MEASUREMENT_KEYS, ["arrival"]).drop("arrival")
    return _report(stored.unionByName(added))


@_query
def store_parameters_first_wins(spark, sf_dir):
    updates = _twice(fixtures.updates(spark, sf_dir), "value", F.lit("late"))
    batch = archive.to_parameter(updates, keep=("arrival",))
    return _report(archive.first_wins(batch, archive.PARAMETER_KEYS, ["arrival"]).drop("arrival"))


@_query
def store_parameters_last_wins(spark, sf_dir):
    updates = _twice(fixtures.updates(spark, sf_dir), "value", F.concat(F.lit("new "), "value"))
    batch = archive.to_parameter(updates, keep=("arrival",))
    return _report(archive.last_wins(batch, archive.PARAMETER_KEYS, ["arrival"]).drop("arrival"))


@_query
def store_alarms_first_wins(spark, sf_dir):
    alerts = _twice(fixtures.alerts(spark, sf_dir), "value", F.col("value") + 1000)
    batch = archive.to_alarm(alerts, digits=6, keep=("arrival",))
    return _report(archive.first_wins(batch, archive.ALARM_KEYS, ["arrival"]).drop("arrival"))
