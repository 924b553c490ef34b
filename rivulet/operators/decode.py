"""Wire text to records: raw packets, readings, updates and alerts.

All functions read a string column ``value`` and keep the columns named in
``keep`` next to the decoded ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import wire
from rivulet.schemas import UNCONVERTED, UNKNOWN, UNKNOWN_CELL

# Entries of an Atlas packet that are status, not measurements.
STATUS_ENTRIES = ("Interrupt_status",)

SENML, ATLAS, TTN = "senml", "atlas", "ttn"
FORMATS = (SENML, ATLAS, TTN)

def decode_raw(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw text into JSON objects and everything else."""
    is_object = wire.json_object(F.col("value")).isNotNull()
    return df.where(is_object), df.where(~is_object)


def parse_entries(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every measurement of every packet in one pass, good or bad.

    The format is decided by the first key present: ``n``, then
    ``externalDeviceId``, then ``hardware_serial``. Bad rows carry a ``reason``
    (``not_json``, ``unknown_format``, ``missing_field``, ``bad_time`` or
    ``bad_value``); one bad entry does not affect the others of its packet.
    """
    packet, kind = F.col("packet"), F.col("format")
    packet_format = (
        F.when(F.map_contains_key(packet, "n"), SENML)
        .when(F.map_contains_key(packet, "externalDeviceId"), ATLAS)
        .when(F.map_contains_key(packet, "hardware_serial"), TTN)
    )

    def by_format(senml: Column, atlas: Column, ttn: Column) -> Column:
        return F.when(kind == SENML, senml).when(kind == ATLAS, atlas).when(kind == TTN, ttn)

    device = by_format(packet["n"], packet["externalDeviceId"], packet["hardware_serial"])
    time_text = by_format(packet["t"], packet["timestamp"], packet["timestamp"])
    payload = wire.json_object(by_format(F.lit(None), packet["decoded"], packet["payload_fields"]))
    # A SenML packet is one value without a name; the others are objects of values.
    single = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("single").alias("value")))
    nothing = F.array(F.lit(None).cast("struct<key: string, value: string>"))
    items = F.when(kind == SENML, single).otherwise(F.coalesce(F.map_entries("payload"), nothing))
    timestamp = F.when(kind == SENML, wire.epoch_seconds(F.col("time_text"))).otherwise(
        wire.packet_time(F.col("time_text"))
    )
    # What holds for a whole packet is computed before its entries are taken apart.
    packets = (
        df.select(*keep, "value", wire.json_object(F.col("value")).alias("packet"))
        .select("*", packet_format.alias("format"))
        .select("*", F.lower(device).alias("device"), time_text.alias("time_text"))
        .select(
            *keep,
            "value",
            "format",
            packet.isNotNull().alias("is_json"),
            "device",
            F.col("time_text").isNotNull().alias("has_time"),
            timestamp.alias("timestamp"),
            packet["v"].alias("single"),
            payload.alias("payload"),
        )
    )
    entries = packets.select("*", F.explode(items).alias("item")).drop("single", "payload")
    status = (kind == ATLAS) & F.col("item.key").isin(*STATUS_ENTRIES)
    entries = entries.where(~F.coalesce(status, F.lit(False)))
    key, text = F.col("item.key"), F.col("item.value")
    number = text.try_cast("double")
    missing = F.col("device").isNull() | ~F.col("has_time") | text.isNull()
    reason = (
        F.when(~F.col("is_json"), F.lit("not_json"))
        .when(kind.isNull(), F.lit("unknown_format"))
        .when(missing, F.lit("missing_field"))
        .when(F.col("timestamp").isNull(), F.lit("bad_time"))
        .when(number.isNull(), F.lit("bad_value"))
    )
    return entries.select(
        *keep,
        "value",
        "format",
        F.concat_ws("-", "device", key).alias("sensorid"),
        "timestamp",
        number.alias("rawValue"),
        reason.alias("reason"),
    )


def parse_packets(
    df: DataFrame, formats: Sequence[str] = FORMATS, keep: Sequence[str] = (), observe: str | None = None
) -> DataFrame:
    """Good measurements of raw packets: sensorid, timestamp, rawValue.

    ``observe`` names a metric that counts entries and rejected ones as they pass.
    """
    entries = parse_entries(df, keep)
    if observe:
        entries = entries.observe(
            observe, F.count(F.lit(1)).alias("entries"), F.count("reason").alias("rejected")
        )
    entries = entries.where(F.col("reason").isNull())
    if set(formats) != set(FORMATS):
        entries = entries.where(F.col("format").isin(*formats))
    return entries.select(*keep, "sensorid", "timestamp", "rawValue")


def parse_rejects(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Packets and single entries that were not understood, with the reason."""
    entries = parse_entries(df, keep).where(F.col("reason").isNotNull())
    return entries.select(*keep, "value", "sensorid", "reason")


def decode_reading(df: DataFrame, keep: Sequence[str] = (), seconds: bool = False) -> DataFrame:
    """Enriched readings; absent attributes get their defaults.

    Times are epoch milliseconds, or seconds as in raw packets. Text without
    sensor id, time or value is dropped.
    """
    m = F.col("m")
    time_of = wire.epoch_seconds if seconds else wire.epoch_millis
    return (
        df.select(*keep, wire.json_object(F.col("value")).alias("m"))
        .select(
            *keep,
            m["n"].alias("sensorid"),
            time_of(m["t"]).alias("timestamp"),
            m["v"].try_cast("double").alias("rawValue"),
            F.coalesce(m["g"], F.lit(UNKNOWN)).alias("location"),
            F.coalesce(m["ty"], F.lit(UNKNOWN)).alias("type"),
            F.coalesce(m["u"], F.lit(UNKNOWN)).alias("unit"),
            F.coalesce(m["c"].try_cast("double"), F.lit(UNCONVERTED)).alias("conValue"),
            F.coalesce(m["r"].try_cast("bigint"), F.lit(UNKNOWN_CELL).cast("bigint")).alias("gridCell"),
        )
        .dropna(subset=["sensorid", "timestamp", "rawValue"])
    )


def decode_update(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Attribute updates; text that lacks one of the four fields is dropped."""
    m = F.col("m")
    fields = ("sensorid", "timestamp", "parameter", "value")
    return (
        df.select(*keep, wire.json_object(F.col("value")).alias("m"))
        .select(
            *keep,
            m["n"].alias("sensorid"),
            wire.epoch_millis(m["t"]).alias("timestamp"),
            m["p"].alias("parameter"),
            m["v"].alias("value"),
        )
        .dropna(subset=list(fields))
    )


def decode_alert(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Alerts; text that lacks one of the five fields is dropped."""
    m = F.col("m")
    fields = ("sensorid", "timestamp", "value", "lower", "upper")
    return (
        df.select(*keep, wire.json_object(F.col("value")).alias("m"))
        .select(
            *keep,
            m["n"].alias("sensorid"),
            wire.epoch_millis(m["t"]).alias("timestamp"),
            m["v"].try_cast("double").alias("value"),
            m["min"].try_cast("double").alias("lower"),
            m["max"].try_cast("double").alias("upper"),
        )
        .dropna(subset=list(fields))
    )
