"""Readings joined with the sensor attributes valid at their event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.curves import interpolate, parse_curve
from rivulet.functions.grid import geolocation_cell
from rivulet.operators.asof import asof_latest
from rivulet.operators.skew import BUCKET_SECONDS
from rivulet.schemas import (
    CELL,
    CONVERSION,
    FAKE_LOCATION,
    FAKE_TYPE,
    GEOLOCATION,
    NOPARAM,
    PARAMETERS,
    TYPE,
    UNCONVERTED,
    UNIT,
    UNKNOWN,
    UNKNOWN_CELL,
)

_ATTRIBUTES = {name: f"attr_{name}" for name in PARAMETERS}
_KNOWN = {f"attr_{name}": f"known_{name}" for name in (TYPE, UNIT)}


def attribute_columns(updates: DataFrame, version: str | None = None, resolution: int = 9) -> DataFrame:
    """Update rows with one typed column per known attribute.

    Texts are parsed here, once per update instead of once per reading. A text
    that does not parse still yields a non-null column, because it replaces the
    value before it.
    """
    value = F.col("value")

    def only(name: str, column):
        return F.when(F.col("parameter") == name, column).alias(_ATTRIBUTES[name])

    located = F.struct(value.alias("text"), geolocation_cell(value, resolution).alias("cell"))
    return updates.where(F.col("parameter").isin(*PARAMETERS) & value.isNotNull()).select(
        "sensorid",
        "timestamp",
        *([version] if version else []),
        only(GEOLOCATION, located),
        only(CELL, F.struct(value.try_cast("bigint").alias("cell"))),
        only(TYPE, value),
        only(UNIT, value),
        only(CONVERSION, F.struct(parse_curve(value).alias("points"))),
    )


def apply_attributes(df: DataFrame) -> DataFrame:
    """Fill the reading columns from as-of attribute columns, which are dropped.

    An attribute the sensor never had leaves the default. ``type`` and ``unit``
    tell a third case apart: known, but not valid yet.
    """
    geolocation, cell, kind, unit, conversion = (F.col(c) for c in _ATTRIBUTES.values())

    def text(value, known):
        return F.coalesce(value, F.when(F.col(known), F.lit(NOPARAM)), F.lit(UNKNOWN))

    converted = interpolate(conversion["points"], F.col("rawValue"))
    columns = {
        "location": F.coalesce(geolocation["text"], F.lit(UNKNOWN)),
        "type": text(kind, f"known_{TYPE}"),
        "unit": text(unit, f"known_{UNIT}"),
        "conValue": F.coalesce(converted, F.lit(UNCONVERTED)),
        "gridCell": F.coalesce(
            geolocation["cell"], cell["cell"], F.lit(UNKNOWN_CELL).cast("bigint")
        ),
    }
    return df.withColumns(columns).drop(*_ATTRIBUTES.values(), *_KNOWN.values())


def enrich_asof(
    readings: DataFrame,
    updates: DataFrame,
    version: str | None = None,
    resolution: int = 9,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Temporal enrichment over the full update history.

    ``readings`` needs sensorid, timestamp and rawValue and keeps its other
    columns. ``version`` names the update column that decides between two
    updates of the same attribute at the same time (the highest wins).
    """
    reading_only = readings.drop("location", "type", "unit", "conValue", "gridCell")
    joined = asof_latest(
        reading_only,
        attribute_columns(updates, version, resolution),
        by=["sensorid"],
        values=list(_ATTRIBUTES.values()),
        tie=version,
        known=_KNOWN,
        bucket_seconds=bucket_seconds,
    )
    return apply_attributes(joined)


def lookup_asof(
    probes: DataFrame, updates: DataFrame, version: str | None = None, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Latest value strictly before ``timestamp`` for (sensorid, parameter) probes.

    NULL when no value was valid yet.
    """
    return asof_latest(
        probes,
        updates.select("sensorid", "parameter", "timestamp", "value", *([version] if version else [])),
        by=["sensorid", "parameter"],
        values=["value"],
        tie=version,
        bucket_seconds=bucket_seconds,
    )


def lookup_value(updates: DataFrame, sensorid: str, parameter: str, before) -> DataFrame:
    """The single-key lookup: one row with the value valid at ``before``, or none."""
    matches = updates.where(
        (F.col("sensorid") == sensorid)
        & (F.col("parameter") == parameter)
        & (F.col("timestamp") < F.lit(before))
    )
    found = matches.agg(F.max_by("value", "timestamp").alias("value"))
    return found.where(F.col("value").isNotNull())


def _unique_updates(updates: DataFrame, version: str | None) -> DataFrame:
    """One row per (sensorid, parameter, timestamp): the highest version."""
    if version is None:
        return updates.select("sensorid", "parameter", "timestamp", "value")
    return updates.groupBy("sensorid", "parameter", "timestamp").agg(
        F.max_by("value", version).alias("value")
    )


def latest_parameters(updates: DataFrame, version: str | None = None) -> DataFrame:
    """Current value of every (sensorid, parameter)."""
    order = F.struct("timestamp", version) if version else F.col("timestamp")
    return updates.groupBy("sensorid", "parameter").agg(
        F.max_by("value", order).alias("value"), F.max("timestamp").alias("timestamp")
    )


def param_versions(updates: DataFrame, version: str | None = None) -> DataFrame:
    """Current and previous value of every (sensorid, parameter)."""
    newest = Window.partitionBy("sensorid", "parameter").orderBy(F.col("timestamp").desc())
    # The rank limit also runs before the shuffle, which then moves two rows per group.
    ranked = (
        _unique_updates(updates, version)
        .withColumn("rank", F.row_number().over(newest))
        .where(F.col("rank") <= 2)
    )

    def pick(rank: int, column: str):
        return F.max(F.when(F.col("rank") == rank, F.col(column)))

    return ranked.groupBy("sensorid", "parameter").agg(
        pick(1, "timestamp").alias("current_ts"),
        pick(1, "value").alias("current_value"),
        pick(2, "timestamp").alias("previous_ts"),
        pick(2, "value").alias("previous_value"),
    )


def pivot_attributes(updates: DataFrame, version: str | None = None) -> DataFrame:
    """One row per sensor with its current attributes as columns."""
    order = F.struct("timestamp", version) if version else F.col("timestamp")

    def current(name: str):
        chosen = F.col("parameter") == name
        return F.max_by(F.when(chosen, F.col("value")), F.when(chosen, order)).alias(name)

    return updates.groupBy("sensorid").agg(*(current(name) for name in PARAMETERS))


def fake_enrich(readings: DataFrame) -> DataFrame:
    """Constant enrichment for pass-through tests of a deployment."""
    columns = {
        "location": F.lit(FAKE_LOCATION),
        "type": F.lit(FAKE_TYPE),
        "conValue": F.col("rawValue"),
    }
    if "unit" not in readings.columns:
        columns["unit"] = F.lit(UNKNOWN)
    if "gridCell" not in readings.columns:
        columns["gridCell"] = F.lit(UNKNOWN_CELL).cast("bigint")
    return readings.withColumns(columns)
