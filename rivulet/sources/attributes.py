"""The attribute history in the forms that jobs read: latest values, snapshots by day, archive.

``record_updates`` takes a batch of updates into all three:

- The archive (``parameters``) gets every version, in its day.
- The latest values are a log: each batch adds one delta, a row for each sensor and attribute
  that it changes. ``merge_latest`` folds base and deltas into a new base. Readers take the
  last base that is complete and the deltas after it, so a merge can run beside them, and
  what they read grows with the sensors, not with the history.
- A snapshot of a day holds the last version before that day for each sensor and attribute.
  A batch of readings needs its own days of the archive back to a snapshot, the snapshot,
  and the latest values, which tell what a sensor has at all. An update that comes after the
  snapshots of later days were made is added to them.

Batches are numbered by the log itself: one more than any before, and a batch that is
repeated finds its number in the name of its delta and takes its place again. Numbers are the versions
of stored rows, so neither repeats nor a clock that steps back change what counts. One
query at a time may write to a database.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import archive
from rivulet.operators.enrich import enrich_asof
from rivulet.sources.tables import DAY, VERSION, append_rows, create_tables, stored

PARAMETERS, LATEST, SNAPSHOTS, COMMITS = "parameters", "latest_parameters", "parameter_snapshots", "attribute_commits"
_ROW = "sensorid STRING, parameter STRING, value STRING, timestamp TIMESTAMP, version BIGINT"
_NAMES = ("sensorid", "parameter", "value", "timestamp", VERSION)
_KEYS = ("sensorid", "parameter")
# Which base or snapshot counts: what is not listed was not finished.
_COMMIT = "kind STRING, piece STRING, number BIGINT, as_of DATE"
# A merge folds this many deltas at least.
MERGE_DELTAS = 16
SNAPSHOT_DAYS = 7


def create_attribute_tables(spark: SparkSession, database: str) -> None:
    """Create what is missing of the archive, the log of latest values and the snapshots."""
    create_tables(spark, database, tables=[PARAMETERS])
    for table, columns, partition in (
        (LATEST, f"{_ROW}, piece STRING", "PARTITIONED BY (piece)"),
        (SNAPSHOTS, f"{_ROW}, as_of DATE, piece STRING", "PARTITIONED BY (as_of, piece)"),
        (COMMITS, _COMMIT, ""),
    ):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet {partition}")


def _newest(rows: DataFrame) -> DataFrame:
    """One row per sensor and attribute: the latest, of equal times the highest version."""
    order = F.struct("timestamp", VERSION)
    picked = rows.groupBy(*_KEYS).agg(F.max_by(F.struct("value", "timestamp", VERSION), order).alias("row"))
    return picked.select(*_KEYS, "row.*")


def _partitions(spark: SparkSession, table: str, column: str) -> list[str]:
    """Values of a partition column that have files, from the listing alone."""
    found = {m[1] for path in stored(spark, table).inputFiles() if (m := re.search(rf"/{column}=([^/]+)/", path))}
    return sorted(found)


def _insert(rows: DataFrame, table: str, partition: str, overwrite: bool = False) -> None:
    how = "OVERWRITE" if overwrite else "INTO"
    rows = rows.select(*_NAMES)
    rows.sparkSession.sql(f"INSERT {how} TABLE {table} PARTITION ({partition}) SELECT * FROM {{rows}}", rows=rows)


def _commit(spark: SparkSession, database: str, kind: str, piece: str, number: int, as_of: date | None = None) -> None:
    row = spark.createDataFrame([(kind, piece, number, as_of)], _COMMIT)
    row.write.insertInto(f"{database}.{COMMITS}")


def _number(piece: str) -> int:
    return int(piece.split("-")[1])


def rebuild_latest(spark: SparkSession, database: str) -> None:
    """A base from an archive that was filled without the log; batches are numbered after its versions."""
    rows = stored(spark, f"{database}.{PARAMETERS}").select(*_NAMES)
    highest = rows.agg(F.max(VERSION)).first()[0]
    if highest is not None:
        piece = f"base-{highest:019d}-{uuid.uuid4().hex}"
        _insert(_newest(rows), f"{database}.{LATEST}", f"piece = '{piece}'")
        _commit(spark, database, "base", piece, highest)


def _pieces(spark: SparkSession, database: str) -> list[str]:
    """Pieces of the log; where there are none yet, the archive may hold rows of before."""
    pieces = _partitions(spark, f"{database}.{LATEST}", "piece")
    if not pieces:
        rebuild_latest(spark, database)
        pieces = _partitions(spark, f"{database}.{LATEST}", "piece")
    return pieces


def _batch_piece(pieces: Sequence[str], query: str, batch: int) -> str:
    """The delta of a batch: the one it has written before, or the next."""
    end = f"-{query}-{batch}"
    again = [p for p in pieces if p.startswith("delta-") and p.endswith(end)]
    number = max(map(_number, pieces), default=0) + 1
    return max(again) if again else f"delta-{number:019d}{end}"


def record_updates(
    updates: DataFrame, database: str, query: str, batch: int, order_by: Sequence[str] = ()
) -> int:
    """Take a batch of updates in, and return its number.

    ``query`` and ``batch`` name the batch; recording it again changes nothing. Of equal
    keys in a batch the last by ``order_by`` counts, else the last row.
    """
    if not re.fullmatch(r"\w+", query):
        raise ValueError("a query name has letters, digits and underscores only")
    spark = updates.sparkSession
    latest = f"{database}.{LATEST}"
    piece = _batch_piece(_pieces(spark, database), query, batch)
    number = _number(piece)
    if not order_by:
        updates, order_by = updates.withColumn("__arrival", F.monotonically_increasing_id()), ["__arrival"]
    updates = updates.where(F.col("timestamp").isNotNull())
    rows = archive.last_wins(updates, archive.PARAMETER_KEYS, order_by)
    rows = rows.select("sensorid", "timestamp", "parameter", "value", F.lit(number).cast("bigint").alias(VERSION)).persist()
    try:
        # The delta comes first, as its name holds the number of the batch.
        _insert(_newest(rows), latest, f"piece = '{piece}'", overwrite=True)
        append_rows(rows, f"{database}.{PARAMETERS}", number)
        made = _snapshots(spark, database)
        if made:
            every = F.array(*(F.struct(F.lit(d).alias("as_of"), F.lit(p).alias("piece")) for d, p in made.items()))
            later = F.filter(every, lambda s: s.as_of > F.to_date(F.col("timestamp")))
            late = rows.where(F.to_date("timestamp") < F.lit(max(made)))
            late.select(*_NAMES, F.inline(later)).write.insertInto(f"{database}.{SNAPSHOTS}")
    finally:
        rows.unpersist()
    return number


def _base(spark: SparkSession, database: str) -> tuple[int, str | None]:
    """The last base that is complete: the number it goes up to, and its piece."""
    bases = stored(spark, f"{database}.{COMMITS}").where("kind = 'base'")
    found = bases.agg(F.max("number").alias("number"), F.max_by("piece", "number").alias("piece")).first()
    return found.number or 0, found.piece


def _snapshots(spark: SparkSession, database: str) -> dict[date, str]:
    """The piece of every day that has a snapshot: that made last."""
    made = stored(spark, f"{database}.{COMMITS}").where("kind = 'snapshot'")
    return {r.as_of: r.piece for r in made.groupBy("as_of").agg(F.max_by("piece", "number").alias("piece")).collect()}


def latest_values(spark: SparkSession, database: str) -> DataFrame:
    """The latest value of every sensor and attribute, from the last base and the deltas after it."""
    table = f"{database}.{LATEST}"
    pieces = _pieces(spark, database)
    number, base = _base(spark, database)
    pieces = [p for p in pieces if p == base or (p.startswith("delta-") and _number(p) > number)]
    return _newest(spark.table(table).where(F.col("piece").isin(pieces)))


def merge_latest(spark: SparkSession, database: str, least: int = MERGE_DELTAS) -> bool:
    """Fold base and deltas into a new base, if there are ``least`` deltas.

    Pieces that the base before it had replaced are emptied; those that this merge replaces
    stay for readers that have begun, until the next.
    """
    table = f"{database}.{LATEST}"
    (number, base), pieces = _base(spark, database), _partitions(spark, table, "piece")
    deltas = [p for p in pieces if p.startswith("delta-") and _number(p) > number]
    if not deltas or len(deltas) < least:
        return False
    through = max(map(_number, deltas))
    piece = f"base-{through:019d}-{uuid.uuid4().hex}"
    _insert(latest_values(spark, database), table, f"piece = '{piece}'")
    _commit(spark, database, "base", piece, through)
    for old in set(pieces) - {base, *deltas}:
        none = spark.createDataFrame([], _ROW)
        _insert(none, table, f"piece = '{old}'", overwrite=True)
    return True


def make_snapshot(spark: SparkSession, database: str, day: date) -> None:
    """The last version before ``day`` for every sensor and attribute, from the snapshot before it."""
    snapshots, made = f"{database}.{SNAPSHOTS}", _snapshots(spark, database)
    before = max((d for d in made if d < day), default=None)
    history = stored(spark, f"{database}.{PARAMETERS}").where(F.col(DAY) < F.lit(day))
    if before:
        older = stored(spark, snapshots).where((F.col("as_of") == F.lit(before)) & (F.col("piece") == made[before]))
        history = history.where(F.col(DAY) >= F.lit(before)).select(*_NAMES).unionByName(older.select(*_NAMES))
    piece = uuid.uuid4().hex
    _insert(_newest(history.select(*_NAMES)), snapshots, f"as_of = '{day}', piece = '{piece}'")
    commits = stored(spark, f"{database}.{COMMITS}").where("kind = 'snapshot'")
    _commit(spark, database, "snapshot", piece, commits.count() + 1, day)


def snapshot_if_due(spark: SparkSession, database: str, updates: DataFrame, every_days: int = SNAPSHOT_DAYS) -> None:
    """A snapshot for the newest day of a batch, if the last is old enough. Days to come get none."""
    newest = updates.agg(F.max(F.to_date("timestamp"))).first()[0]
    if newest is None or newest > date.today():
        return
    last = max(_snapshots(spark, database), default=None)
    if last is None or (newest - last).days >= every_days:
        make_snapshot(spark, database, newest)


def _spans(days: Sequence[date], snapshots: Sequence[date]) -> tuple[list[tuple[date | None, date]], list[date]]:
    """Days of the archive that readings of ``days`` need, as spans, and the snapshots they start from."""
    spans: list[tuple[date | None, date]] = []
    used = set()
    for day in sorted(days):
        start = max((s for s in snapshots if s <= day), default=None)
        if start:
            used.add(start)
        if spans and start == spans[-1][0]:
            spans[-1] = (start, day)
        else:
            spans.append((start, day))
    return spans, sorted(used)


def history_of_days(spark: SparkSession, database: str, days: Sequence[date]) -> DataFrame:
    """Versions that decide every as-of lookup of these days: a part of the archive, snapshots, latest values."""
    made = _snapshots(spark, database)
    spans, used = _spans(days, list(made))

    def within(span: tuple[date | None, date]) -> Column:
        start, end = span
        return F.col(DAY).between(F.lit(start), F.lit(end)) if start else F.col(DAY) <= F.lit(end)

    wanted = F.lit(False)
    for span in spans:
        wanted = wanted | within(span)
    archived = stored(spark, f"{database}.{PARAMETERS}").where(wanted).select(*_NAMES)
    wanted = F.col("as_of").isin(used) & F.col("piece").isin([made[d] for d in used])
    before = stored(spark, f"{database}.{SNAPSHOTS}").where(wanted).select(*_NAMES)
    return archived.unionByName(before).unionByName(latest_values(spark, database).select(*_NAMES))


def enrich_from_archive(readings: DataFrame, database: str, resolution: int = 9) -> DataFrame:
    """As-of enrichment of readings of a few days, such as a micro-batch, against the stored history.

    Only the days of the readings, back to a snapshot, and sensors that occur take part.
    The days are collected; there is one for each calendar day that has readings.
    """
    spark = readings.sparkSession
    days = [r.day for r in readings.select(F.to_date("timestamp").alias("day")).distinct().collect()]
    history = history_of_days(spark, database, [d for d in days if d is not None])
    history = history.join(readings.select("sensorid").distinct(), "sensorid", "left_semi")
    return enrich_asof(readings, history, VERSION, resolution)
