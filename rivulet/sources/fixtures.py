"""Sensor inputs derived from the given ``events`` table.

Each view is a projection of the whole table, so its size grows with it. Times
in the table have no zone and mean UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import use_utc


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def readings(spark: SparkSession, sf_dir: str, joined: bool = False) -> DataFrame:
    """Raw readings of one sensor per user.

    Where readings and updates are ``joined`` each takes its share of the event
    types, and both together the whole table.
    """
    rows = events(spark, sf_dir)
    if joined:
        rows = rows.where(F.col("event_type").isin("click", "view", "error"))
    return rows.selectExpr(
        "event_id as reading_id",
        "'s' || cast(user_id as string) as sensorid",
        "ts as timestamp",
        "value as rawValue",
    )


def updates(spark: SparkSession, sf_dir: str, joined: bool = False) -> DataFrame:
    """Attribute updates, some of them with values that do not parse."""
    rows = events(spark, sf_dir)
    if joined:
        rows = rows.where(F.col("event_type").isin("signup", "purchase"))
    return rows.selectExpr(
        "event_id as update_id",
        "'s' || cast(user_id as string) as sensorid",
        "ts as timestamp",
        """case event_id % 5 when 0 then 'geolocation' when 1 then 'cell' when 2 then 'type'
           when 3 then 'unit' else 'conversion' end as parameter""",
        """case event_id % 5
           when 0 then case when event_id % 35 = 0 then 'nowhere'
             else '52.' || lpad(cast(event_id % 1000 as string), 3, '0')
               || ',13.' || lpad(cast(event_id % 700 as string), 3, '0') end
           when 1 then cast(event_id % 7 as string)
           when 2 then 'T' || cast(event_id % 3 as string)
           when 3 then case event_id % 2 when 0 then 'mm' else 'l/s' end
           else case when event_id % 45 = 4 then '[(0,0)]'
             else '[(0, 0),(50.5,' || cast(event_id % 90 + 1 as string)
               || '),(300,' || cast(event_id % 90 + 200 as string) || ')]' end
           end as value""",
    )


def raw_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of the three vendor formats, unknown objects and broken text."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        """case event_id % 5
           when 0 then '{"n":"S' || cast(user_id as string) || '","t":'
             || cast(1704067200 + event_id * 60 as string) || ',"v":' || cast(value as string) || '}'
           when 1 then '{"externalDeviceId":"DEV' || cast(user_id as string) || '","timestamp":"2024-01-'
             || lpad(cast(event_id % 28 + 1 as string), 2, '0') || 'T'
             || lpad(cast(event_id % 24 as string), 2, '0') || ':00:00.250Z","decoded":{"level":'
             || cast(value as string) || ',"temp":' || cast(event_id % 30 as string)
             || ',"Interrupt_status":1}}'
           when 2 then '{"hardware_serial":"TTN' || cast(user_id as string) || '","timestamp":"2024-01-'
             || lpad(cast(event_id % 28 + 1 as string), 2, '0') || 'T'
             || lpad(cast(event_id % 24 as string), 2, '0') || ':30:00.000Z","payload_fields":{"flow":'
             || cast(value as string) || '}}'
           when 3 then '{"other":"' || event_type || '"}'
           else '{"n":"S' || cast(user_id as string) || '","t":' end as value""",
    )


def cell_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted readings that already carry a grid cell."""
    return events(spark, sf_dir).selectExpr(
        "event_id as reading_id",
        "'s' || cast(user_id as string) as sensorid",
        "user_id % 7 as gridCell",
        "ts as timestamp",
        "value as conValue",
    )


def typed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted readings of one dense sensor per event type."""
    return events(spark, sf_dir).selectExpr(
        "event_id as reading_id",
        "event_type as sensorid",
        "ts as timestamp",
        "value as conValue",
    )


def reading_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched readings as text: full, with absent fields, and unusable."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        """case event_id % 4
           when 0 then '{"n":"s' || cast(user_id as string) || '","t":' || cast(unix_millis(ts) as string)
             || ',"v":' || cast(value as string) || ',"g":"52.5,13.4","r":"' || cast(event_id % 50 as string)
             || '","ty":"level","u":"mm","c":' || cast(value as string) || '}'
           when 1 then '{"n":"s' || cast(user_id as string) || '","t":"' || cast(unix_millis(ts) as string)
             || '","v":"' || cast(value as string) || '"}'
           when 2 then '{"n":"s' || cast(user_id as string) || '","t":' || cast(unix_millis(ts) as string)
             || ',"v":' || cast(value as string) || ',"ty":null,"u":"l/s","extra":{"k":1}}'
           else case when event_id % 8 = 3 then '{"n":"s' || cast(user_id as string) || '","v":1.0}'
             else '[' || cast(value as string) || ']' end
           end as value""",
    )


def update_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute updates as text, spaced or compact, and unusable ones."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        """case event_id % 4
           when 0 then '{"n": "s' || cast(user_id as string) || '", "t": ' || cast(unix_millis(ts) as string)
             || ', "p": "unit", "v": "mm"}'
           when 1 then '{"n":"s' || cast(user_id as string) || '","t":' || cast(unix_millis(ts) as string)
             || ',"p":"conversion","v":"[(0, 0),(10,' || cast(event_id % 90 as string) || ')]"}'
           when 2 then '{"n":"s' || cast(user_id as string) || '","t":' || cast(unix_millis(ts) as string)
             || ',"p":"cell","v":' || cast(event_id % 7 as string) || '}'
           else '{"n":"s' || cast(user_id as string) || '","t":' || cast(unix_millis(ts) as string)
             || ',"p":"type"}' end as value""",
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts around each event value; some intervals have width zero."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "'s' || cast(user_id as string) as sensorid",
        "ts as timestamp",
        "value",
        "cast(event_id % 40 as double) as lower",
        "cast(event_id % 40 + event_id % 11 as double) as upper",
    )


def alert_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts as text; one in three has no upper bound."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        """'{"n":"s' || cast(user_id as string) || '","t":' || cast(unix_millis(ts) as string)
           || ',"v":' || cast(value as string) || ',"min":' || cast(event_id % 40 as string)
           || case when event_id % 3 = 2 then '}'
                else ',"max":' || cast(event_id % 40 + event_id % 11 as string) || '}' end as value""",
    )
