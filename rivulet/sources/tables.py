"""Archive tables for measurements, parameters and alarms.

Tables are partitioned by day. First-write-wins inserts compare keys only with
the days and times the batch covers. Last-write-wins inserts append a newer
version, so a lost executor or a repeated batch cannot damage stored rows, and
``current_rows`` gives one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import archive

# Columns of the archive tables.
COLUMNS = {
    "measurements": (
        "sensorid STRING, timestamp TIMESTAMP, type STRING, unit STRING, location STRING, "
        "rawValue DOUBLE, conValue DOUBLE"
    ),
    "parameters": "sensorid STRING, timestamp TIMESTAMP, parameter STRING, value STRING",
    "alarms": "sensorid STRING, timestamp TIMESTAMP, message STRING",
}
KEYS = {
    "measurements": archive.MEASUREMENT_KEYS,
    "parameters": archive.PARAMETER_KEYS,
    "alarms": archive.ALARM_KEYS,
}
# Higher versions replace lower ones with the same key.
VERSION, DAY = "version", "day"


def create_tables(
    spark: SparkSession, database: str, fresh: bool = False, tables: Sequence[str] = tuple(COLUMNS)
) -> None:
    """Create missing tables; ``fresh`` drops the database and its data first."""
    if fresh:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} "
            f"({COLUMNS[table]}, {VERSION} BIGINT, {DAY} DATE) USING parquet PARTITIONED BY ({DAY})"
        )


def stored(spark: SparkSession, table: str) -> DataFrame:
    """Rows of a table, including those that other sessions have just written."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def append_rows(rows: DataFrame, table: str, version: int = 0) -> None:
    """Append rows without looking at what is stored."""
    keys = list(KEYS[table.split(".")[-1]])
    rows = rows.withColumn(VERSION, F.lit(version).cast("bigint")).withColumn(
        DAY, F.to_date("timestamp")
    )
    names = rows.sparkSession.table(table).columns
    # Rebalancing makes few files per day and still splits a day that is large.
    rows = rows.select(*names).hint("rebalance", DAY).sortWithinPartitions(DAY, *keys)
    rows.write.insertInto(table)


def _in_arrival(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> tuple[DataFrame, Sequence[str], list]:
    """Rows, their keys and their order; what ``order_by`` leaves open is as the rows come."""
    return batch.withColumn("__arrival", F.monotonically_increasing_id()), keys, [*order_by, "__arrival"]


def insert_first_wins(batch: DataFrame, table: str, order_by: Sequence[str] = ()) -> None:
    """Insert the rows whose key is not stored yet; of several the earliest by ``order_by``."""
    spark = batch.sparkSession
    keys = KEYS[table.split(".")[-1]]
    first = archive.first_wins(*_in_arrival(batch, keys, order_by)).drop("__arrival").persist()
    try:
        low, high = first.agg(F.min("timestamp"), F.max("timestamp")).first()
        if low is None:
            return
        present = stored(spark, table).where(
            F.col("timestamp").between(F.lit(low), F.lit(high))
            & F.col(DAY).between(F.to_date(F.lit(low)), F.to_date(F.lit(high)))
        )
        append_rows(first.join(present.select(*keys), list(keys), "left_anti"), table, 0)
    finally:
        first.unpersist()


def upsert_last_wins(
    batch: DataFrame, table: str, order_by: Sequence[str] = (), version: int | None = None
) -> None:
    """Store the latest row of every key in the batch; it replaces stored ones.

    The version defaults to one more than any in the days that the batch covers, so what
    counts does not depend on a clock.
    """
    spark = batch.sparkSession
    keys = KEYS[table.split(".")[-1]]
    last = archive.last_wins(*_in_arrival(batch, keys, order_by)).drop("__arrival").persist()
    try:
        if version is None:
            low, high = last.agg(F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))).first()
            if low is None:
                return
            days = stored(spark, table).where(F.col(DAY).between(F.lit(low), F.lit(high)))
            version = (days.agg(F.max(VERSION)).first()[0] or 0) + 1
        append_rows(last, table, version)
    finally:
        last.unpersist()


def current_rows(spark: SparkSession, table: str) -> DataFrame:
    """One row per key: the one with the highest version."""
    keys = KEYS[table.split(".")[-1]]
    rows = stored(spark, table).drop(DAY)
    return archive.last_wins(rows, keys, [VERSION]).drop(VERSION)


def compact(spark: SparkSession, table: str, target: str) -> None:
    """Write the current rows of a table to a new table of the same layout."""
    database, _, name = target.rpartition(".")
    source = table.split(".")[-1]
    if name == source:
        create_tables(spark, database, tables=[source])
    else:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {target} ({COLUMNS[source]}, {VERSION} BIGINT, {DAY} DATE) "
            f"USING parquet PARTITIONED BY ({DAY})"
        )
    keys = KEYS[source]
    rows = archive.last_wins(stored(spark, table), keys, [VERSION])
    names = spark.table(target).columns
    rows.select(*names).hint("rebalance", DAY).sortWithinPartitions(DAY, *keys).write.insertInto(target)
