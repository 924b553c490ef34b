"""Enrichment of a reading stream with an update stream.

State is kept per sensor: for every parameter its versions, in time buckets. A micro-batch
first adds its updates and then looks its readings up, so the result does not depend on the
order inside the batch. A reading reads two buckets of a parameter at most, its own and the
one before. State can be bounded to the newest buckets; readings older than what it holds
come out marked, to be looked up in the archive.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.functions.curves import parse_curve
from rivulet.functions.grid import geolocation_cell
from rivulet.operators.enrich import apply_attributes, enrich_asof
from rivulet.operators.skew import BUCKET_SECONDS
from rivulet.schemas import CELL, CONVERSION, GEOLOCATION, PARAMETERS, TYPE, UNIT
from rivulet.session import use_rocksdb
from rivulet.sources.attributes import enrich_from_archive

_OUTPUT = (
    "sensorid string, timestamp timestamp, rawValue double, {}, known_type boolean, known_unit boolean, "
    "beyond boolean, parameter string, value string"
).format(", ".join(f"attr_{name} string" for name in PARAMETERS))
_COLUMNS = [field.split()[0] for field in _OUTPUT.split(", ")]


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").astype("int64")


class Versions:
    """Versions of one sensor's attributes in map states: buckets of versions, and which there are.

    ``older`` of a parameter says that versions before the first one held exist elsewhere.
    With ``keep`` the newest buckets of a parameter stay, that many; the rest is forgotten.
    """

    def __init__(self, buckets, index, width: int, keep: int | None):
        self.buckets, self.index, self.width, self.keep = buckets, index, width, keep

    def _at(self, parameter: str) -> tuple[list[int], bool]:
        if not self.index.containsKey((parameter,)):
            return [], False
        numbers, older = self.index.getValue((parameter,))
        return list(numbers), older

    def _bucket(self, parameter: str, number: int) -> tuple[list[int], list[str]]:
        times, texts = self.buckets.getValue((parameter, number))
        return list(times), list(texts)

    def add(self, parameter: str, news: list[tuple[int, str]], older: bool = False) -> None:
        """Add versions; of equal times the later in ``news`` counts, and any of them before stored ones."""
        numbers, had = self._at(parameter)
        older = older or had
        if had and numbers:
            # What comes before the first version held belongs to what is elsewhere.
            first = self._bucket(parameter, numbers[0])[0][0]
            news = [v for v in news if v[0] >= first]
        by_bucket: dict[int, dict[int, str]] = {}
        for time, text in news:
            by_bucket.setdefault(time // self.width, {})[time] = text
        for number, versions in by_bucket.items():
            if number in numbers:
                versions = dict(zip(*self._bucket(parameter, number), strict=True)) | versions
            else:
                bisect.insort(numbers, number)
            times = sorted(versions)
            self.buckets.updateValue((parameter, number), (times, [versions[t] for t in times]))
        while self.keep and len(numbers) > self.keep:
            self.buckets.removeKey((parameter, numbers.pop(0)))
            older = True
        if by_bucket or older != had or not self.index.containsKey((parameter,)):
            self.index.updateValue((parameter,), (numbers, older))

    def before(self, parameter: str, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """The text strictly before each time, where it lies beyond what is held, and whether the parameter is known."""
        texts, beyond = np.full(len(times), None, dtype=object), np.zeros(len(times), dtype=bool)
        numbers, older = self._at(parameter)
        if not numbers:
            return texts, beyond | older, older or self.index.containsKey((parameter,))
        places = np.searchsorted(numbers, times // self.width, side="right") - 1
        for place in np.unique(places).tolist():
            rows = places == place
            # The last version of the bucket before stands in front of the bucket's own.
            starts, values = self._bucket(parameter, numbers[place]) if place >= 0 else ([], [])
            found = np.searchsorted(np.array(starts, dtype="int64"), times[rows], side="left")
            front = None
            if place > 0 and (found == 0).any():
                front = self._bucket(parameter, numbers[place - 1])[1][-1]
            texts[rows] = np.array([front, *values], dtype=object)[found]
            beyond[rows] = (found == 0) & (place <= 0) & older
        return texts, beyond, True


class AttributeState(StatefulProcessor):
    """Versions of the attributes of one sensor.

    With ``keep`` the newest buckets of each attribute are held, that many; without it no
    version is ever dropped, as a reading may come however late. With ``wait`` readings are
    held until the watermark passes them; later ones are not held. ``complete`` says that
    the initial state holds all versions there are. With ``pass_on`` updates come out too.
    """

    def __init__(self, wait: bool, width: int, keep: int | None, complete: bool, pass_on: bool):
        self.wait, self.width, self.keep = wait, width, keep
        self.complete, self.pass_on = complete, pass_on

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        buckets = handle.getMapState("buckets", "parameter string, bucket bigint", "times array<bigint>, texts array<string>")
        index = handle.getMapState("index", "parameter string", "numbers array<bigint>, older boolean")
        self.versions = Versions(buckets, index, self.width, self.keep)
        if self.wait:
            self.waiting = handle.getListState("waiting", "time bigint, rawValue double")
            self.due = handle.getValueState("due", "milliseconds bigint")

    def _add(self, rows: pd.DataFrame, older: bool = False) -> None:
        for parameter, own in rows.groupby("parameter", sort=False):
            # An update without a time is valid at none, but the parameter is known.
            own = own[own["timestamp"].notna()]
            self.versions.add(parameter, list(zip(_micros(own["timestamp"]).tolist(), own["value"], strict=True)), older)

    def _resolve(self, sensorid: str, times: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        out = {"sensorid": sensorid, "timestamp": pd.to_datetime(times, unit="us"), "rawValue": values}
        beyond = np.zeros(len(times), dtype=bool)
        for parameter in PARAMETERS:
            out[f"attr_{parameter}"], past, known = self.versions.before(parameter, times)
            beyond |= past
            if parameter in (TYPE, UNIT):
                out[f"known_{parameter}"] = known
        frame = pd.DataFrame(out | {"beyond": beyond, "parameter": None, "value": None}, index=range(len(times)))
        return frame[_COLUMNS]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._add(initialState.sort_values("timestamp", kind="stable"), not self.complete)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        is_update = batch["parameter"].notna()
        if is_update.any():
            news = batch[is_update].sort_values("version", kind="stable")
            # As in the archive, no sensor is the same as another without a name.
            if pd.notna(key[0]):
                self._add(news[news["value"].notna()])
            if self.pass_on:
                given = {"sensorid": key[0], "beyond": False} | {c: news[c].to_numpy() for c in ("timestamp", "parameter", "value")}
                yield pd.DataFrame({c: given.get(c) for c in _COLUMNS}, index=range(len(news)), dtype=object)
        readings = batch[~is_update]
        if readings.empty:
            return
        times = _micros(readings["timestamp"])
        values = readings["rawValue"].to_numpy("float64")
        ready = np.ones(len(times), dtype=bool)
        if self.wait:
            ready = times < timerValues.getCurrentWatermarkInMs() * 1000
            held = ~ready
            if held.any():
                self.waiting.appendList(list(zip(times[held].tolist(), values[held].tolist(), strict=True)))
                self._wake(int(times[held].min()))
        if ready.any():
            yield self._resolve(key[0], times[ready], values[ready])

    def _wake(self, earliest: int) -> None:
        """Keep one timer per sensor: that of its earliest waiting reading."""
        # A timer fires once the watermark is past it, that is, past the reading.
        due = earliest // 1000 + 1
        if self.due.exists():
            (current,) = self.due.get()
            if current <= due:
                return
            self.handle.deleteTimer(current)
        self.handle.registerTimer(due)
        self.due.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.wait:
            return
        self.due.clear()
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((row[0], row[1]) for row in self.waiting.get())
        count = bisect.bisect_left(held, (watermark,))
        ready, rest = held[:count], held[count:]
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0])
        else:
            self.waiting.clear()
        if ready:
            times = np.array([row[0] for row in ready], dtype="int64")
            values = np.array([row[1] for row in ready], dtype="float64")
            yield self._resolve(key[0], times, values)


def lookup_stream(
    readings: DataFrame,
    updates: DataFrame,
    initial: DataFrame | None = None,
    wait_for_watermark: bool = False,
    keep_buckets: int | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
    initial_is_complete: bool = True,
    pass_updates_on: bool = False,
) -> DataFrame:
    """Readings with attribute texts as of their time, for :func:`finish_batch`.

    ``beyond`` marks those older than what state holds of some attribute: with
    ``keep_buckets`` only the newest time buckets stay, and with ``initial_is_complete``
    off the versions in ``initial`` are the latest of more. With ``pass_updates_on``
    updates come out as rows with a ``parameter``.
    """
    use_rocksdb(readings.sparkSession)
    tagged = readings.select(
        "sensorid",
        "timestamp",
        "rawValue",
        F.lit(None).cast("string").alias("parameter"),
        F.lit(None).cast("string").alias("value"),
        F.lit(0).cast("bigint").alias("version"),
    ).unionByName(
        updates.select(
            "sensorid",
            "timestamp",
            F.lit(None).cast("double").alias("rawValue"),
            "parameter",
            "value",
            (F.col("version") if "version" in updates.columns else F.lit(0)).cast("bigint").alias("version"),
        )
    )
    # The watermark stays with the query but leaves the column: rows behind it
    # would otherwise be filtered before they reach the state.
    tagged = tagged.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp")))
    start = None
    if initial is not None:
        start = initial.select("sensorid", "parameter", "value", "timestamp").groupBy("sensorid")
    state = AttributeState(
        wait_for_watermark, bucket_seconds * 1_000_000, keep_buckets, initial_is_complete, pass_updates_on
    )
    return tagged.groupBy("sensorid").transformWithStateInPandas(
        statefulProcessor=state,
        outputStructType=_OUTPUT,
        outputMode="Append",
        timeMode="EventTime" if wait_for_watermark else "None",
        initialState=start,
    )


def enrich_stream(
    readings: DataFrame,
    updates: DataFrame,
    initial: DataFrame | None = None,
    wait_for_watermark: bool = False,
    resolution: int = 9,
) -> DataFrame:
    """Enriched readings of a stream; updates change state and give no output.

    Every reading comes out once, at once, with the attributes known by then. With
    ``wait_for_watermark`` it comes out when the watermark has passed it, so
    updates that are late within the watermark count as well; both inputs then
    need a watermark. Readings and updates behind the watermark are used as they
    come. ``initial`` holds the attribute versions (sensorid, parameter, value,
    timestamp) to start with; readings older than a sensor's oldest are right
    only if it has all of them. State holds all versions; :func:`lookup_stream`
    and :func:`finish_batch` bound it, with an archive for the rest.
    """
    looked_up = lookup_stream(readings, updates, initial, wait_for_watermark)
    return apply_attributes(_typed(looked_up.drop("beyond", "parameter", "value"), resolution))


def finish_batch(batch: DataFrame, database: str, resolution: int = 9) -> DataFrame:
    """Enriched readings of one micro-batch of :func:`lookup_stream`.

    Those beyond the state are looked up in the stored history, of which only their days
    and a snapshot are read. The batch's updates must have been stored.
    """
    came = batch.where(F.col("parameter").isNull()).drop("parameter", "value")
    held = apply_attributes(_typed(came.where(~F.col("beyond")).drop("beyond"), resolution))
    older = came.where("beyond").select("sensorid", "timestamp", "rawValue")
    return held.unionByName(enrich_from_archive(older, database, resolution))


def _typed(df: DataFrame, resolution: int) -> DataFrame:
    """Attribute texts as the typed columns that batch enrichment works with."""

    def wrapped(name: str, *fields):
        text = F.col(f"attr_{name}")
        return F.when(text.isNotNull(), F.struct(*(f(text) for f in fields)))

    return df.withColumns(
        {
            f"attr_{GEOLOCATION}": wrapped(
                GEOLOCATION,
                lambda text: text.alias("text"),
                lambda text: geolocation_cell(text, resolution).alias("cell"),
            ),
            f"attr_{CELL}": wrapped(CELL, lambda text: text.try_cast("bigint").alias("cell")),
            f"attr_{CONVERSION}": wrapped(CONVERSION, lambda text: parse_curve(text).alias("points")),
        }
    )


def enrich_batch(readings: DataFrame, parameters: DataFrame, resolution: int = 9) -> DataFrame:
    """Enrich one micro-batch against the archived update history.

    Only the history of sensors in the batch takes part.
    """
    sensors = readings.select("sensorid").distinct()
    history = parameters.join(sensors, "sensorid", "left_semi")
    version = "version" if "version" in parameters.columns else None
    return enrich_asof(readings, history, version, resolution)
