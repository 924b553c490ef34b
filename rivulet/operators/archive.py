"""Rows of the archive tables and the rules for duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.alerts import alert_message

MEASUREMENT_KEYS = ("sensorid", "timestamp")
PARAMETER_KEYS = ("sensorid", "parameter", "timestamp")
ALARM_KEYS = ("sensorid", "timestamp")


def to_measurement(readings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return readings.select(
        *keep, "sensorid", "timestamp", "type", "unit", "location", "rawValue", "conValue"
    )


def to_parameter(updates: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return updates.select(*keep, "sensorid", "timestamp", "parameter", "value")


def to_alarm(alerts: DataFrame, digits: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    message = alert_message(F.col("value"), F.col("lower"), F.col("upper"), digits)
    return alerts.select(*keep, "sensorid", "timestamp", message.alias("message"))


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    # An aggregate keeps one row per key on the map side already, so a key with
    # very many copies does not reach a single task in full.
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order_by))
    return df.groupBy(*keys).agg(row.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def first_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The earliest row of every key by arrival order."""
    return _one_per_key(df, keys, order_by, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The latest row of every key by arrival order."""
    return _one_per_key(df, keys, order_by, F.max_by)


def new_rows(
    batch: DataFrame, existing_keys: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Rows of ``batch`` to insert so that the first write of every key wins."""
    return first_wins(batch, keys, order_by).join(existing_keys.select(*keys), list(keys), "left_anti")
