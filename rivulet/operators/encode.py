"""Records to wire text: ``key`` (sensor id) and JSON ``value`` columns.

Times go out as epoch milliseconds, the unit the decoders read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _encode(df: DataFrame, fields: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    value = F.to_json(F.struct(*(column.alias(key) for key, column in fields.items())))
    return df.select(*keep, F.col("sensorid").alias("key"), value.alias("value"))


def encode_reading(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    fields = {
        "n": F.col("sensorid"),
        "t": F.unix_millis("timestamp"),
        "v": F.col("rawValue"),
        "g": F.col("location"),
        "r": F.col("gridCell"),
        "ty": F.col("type"),
        "u": F.col("unit"),
        "c": F.col("conValue"),
    }
    return _encode(df, fields, keep)


def encode_update(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    fields = {
        "n": F.col("sensorid"),
        "t": F.unix_millis("timestamp"),
        "p": F.col("parameter"),
        "v": F.col("value"),
    }
    return _encode(df, fields, keep)


def encode_alert(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    fields = {
        "n": F.col("sensorid"),
        "t": F.unix_millis("timestamp"),
        "v": F.col("value"),
        "min": F.col("lower"),
        "max": F.col("upper"),
    }
    return _encode(df, fields, keep)
