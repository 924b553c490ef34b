"""Sliding-window forecast on a stream, from moments of panes.

State of a sensor is one summary for each pane that an open window may hold, and the
readings that may still be joined by earlier ones, those within the lateness. A summary has
a fixed size, whatever the number of readings: their count, a few values at both ends, and
the sums of lag products that the estimator needs. Summaries of neighbouring stretches of
time merge, so a pane takes readings in as their lateness passes, and a window is its panes
merged in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.operators.forecast import MIN_HISTORY, MOMENTS, estimate, forecastable, interval_alerts
from rivulet.operators.windows import Sliding, duration_seconds
from rivulet.session import use_rocksdb
from rivulet.streaming.time import DISORDER, LATENESS, with_event_time

_HEAD, _TAIL, _LAGS = 3, 5, 3
_SECOND = 1_000_000


class Stretch(NamedTuple):
    """Readings that follow each other: the first and last values, and sums over all but the last.

    ``sums`` has d*d, d*d[-1] and d*d[-2] of the differences d between readings, as far as
    the values that a product needs are in the stretch.
    """

    count: int
    head: tuple[float, ...]
    tail: tuple[float, ...]
    sums: tuple[float, ...]
    newest: int


def stretch_of(times: np.ndarray, values: np.ndarray) -> Stretch:
    """Summary of readings in order."""
    steps = np.diff(values[:-1])
    sums = (float(steps @ steps), float(steps[1:] @ steps[:-1]), float(steps[2:] @ steps[:-2]))
    return Stretch(len(values), tuple(values[:_HEAD].tolist()), tuple(values[-_TAIL:].tolist()), sums, int(times[-1]))


def _products(values: tuple[float, ...], at: int) -> list[float | None]:
    """The products of the value at a place, where the values before it that they need are given."""
    d = [values[i] - values[i - 1] for i in range(at, max(0, at - _LAGS), -1)]
    return [d[0] * d[k] if k < len(d) else None for k in range(_LAGS)]


def merged(first: Stretch | None, then: Stretch) -> Stretch:
    """Summary of two stretches, of which the second comes later."""
    if first is None:
        return then
    sums = [a + b for a, b in zip(first.sums, then.sums, strict=True)]
    known = first.tail[-_LAGS - 1 :]
    # The last value of the first stretch is no longer the newest.
    for k, product in enumerate(_products(known, len(known) - 1)):
        if product is not None:
            sums[k] += product
    joined = known + then.head
    for i in range(min(len(then.head), then.count - 1)):
        # Products with fewer steps back than the value's place are inside the second stretch.
        for k, product in enumerate(_products(joined, len(known) + i)):
            if k >= i and product is not None:
                sums[k] += product
    return Stretch(
        first.count + then.count,
        (first.head + then.head)[:_HEAD],
        (first.tail + then.tail)[-_TAIL:],
        tuple(sums),
        then.newest,
    )


def _moments(window: Stretch) -> dict:
    head = window.head + (None,) * (_HEAD - len(window.head))
    tail = window.tail[::-1] + (None,) * (_TAIL - len(window.tail))
    return dict(zip(MOMENTS, (window.count, *head, *tail, *window.sums), strict=True))


_OUTPUT = "sensorid string, last_pane bigint, timestamp timestamp, revision int, rows bigint, " + ", ".join(
    f"{name} double" for name in MOMENTS[1:]
)
_COLUMNS = [field.split()[0] for field in _OUTPUT.split(", ")]
_STATE = "count bigint, head array<double>, tail array<double>, sums array<double>, newest bigint"


class PaneState(StatefulProcessor):
    """Pane summaries of one sensor, and its readings that are within the lateness.

    A window fires when the watermark reaches its end, and again, with the next revision,
    when readings arrive that belong to it and are behind the watermark by no more than
    ``lateness`` microseconds. Readings later than that are left out of all windows.
    """

    def __init__(self, windows: Sliding, lateness: int):
        self.windows, self.lateness = windows, lateness
        self.pane_size = windows.pane * _SECOND

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane bigint", _STATE)
        self.open = handle.getValueState("open", "times array<bigint>, values array<double>")
        # Up to where readings are in summaries, and up to where windows have fired.
        self.marks = handle.getValueState("marks", "folded bigint, fired bigint, due bigint")
        self.revisions = handle.getMapState("revisions", "last_pane bigint", "revision int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        times = batch["timestamp"].to_numpy("datetime64[us]").astype("int64")
        values = batch["conValue"].to_numpy("float64")
        folded, fired, due = self._marks()
        if folded is not None:
            times, values = times[times >= folded], values[times >= folded]
        if not len(times):
            return
        had_times, had_values = self._open()
        times_all, values_all = np.concatenate([had_times, times]), np.concatenate([had_values, values])
        order = np.lexsort((values_all, times_all))
        self.open.update((times_all[order].tolist(), values_all[order].tolist()))
        if fired is not None and (times < fired).any():
            late = np.unique(times[times < fired] // self.pane_size)
            yield from self._fire(key[0], self._ends(late.tolist(), None, fired))
        first = max(int(times.min()), fired) if fired is not None else int(times.min())
        due = self._wake((first // self.pane_size + 1) * self.pane_size, due)
        self.marks.update((folded, fired, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        folded, fired, due = self._marks()
        due = None
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        times, _ = self._open()
        held = set((times // self.pane_size).tolist()) | {pane for (pane,) in self.panes.keys()}
        yield from self._fire(key[0], self._ends(held, fired, watermark))
        self._fold(watermark - self.lateness)
        # Windows that can take no more readings leave nothing behind but the panes of later ones.
        passed = (watermark - self.lateness) // self.pane_size - self.windows.panes
        for (pane,) in list(self.panes.keys()):
            if pane <= passed:
                self.panes.removeKey((pane,))
                held.discard(pane)
        for (end,) in list(self.revisions.keys()):
            if (end + 1) * self.pane_size <= watermark - self.lateness:
                self.revisions.removeKey((end,))
        if held:
            # The next window that ends with data in it, or the next that goes out of lateness.
            following = max(watermark, min(held) * self.pane_size)
            due = self._wake((following // self.pane_size + 1) * self.pane_size, None)
        self.marks.update((watermark - self.lateness, watermark, due))

    def _marks(self) -> tuple[int | None, int | None, int | None]:
        return tuple(self.marks.get()) if self.marks.exists() else (None, None, None)

    def _open(self) -> tuple[np.ndarray, np.ndarray]:
        times, values = self.open.get() if self.open.exists() else ([], [])
        return np.array(times, dtype="int64"), np.array(values, dtype="float64")

    def _wake(self, time: int, due: int | None) -> int:
        """One timer per sensor, for the earliest end of a pane that matters."""
        # A timer fires once the watermark is past it, so a window's own end is past by then.
        milliseconds = -(-time // 1000) - 1
        if due is not None:
            if due <= milliseconds:
                return due
            self.handle.deleteTimer(due)
        self.handle.registerTimer(milliseconds)
        return milliseconds

    def _ends(self, panes: Iterable[int], after: int | None, until: int) -> list[int]:
        """Last panes of windows that hold one of ``panes`` and end after one time and up to another."""
        reach, step = self.windows.panes, self.windows.step
        ends = {end for pane in panes for end in range(pane, pane + reach) if (end - reach + 1) % step == 0}
        size = self.pane_size
        return sorted(e for e in ends if (after is None or (e + 1) * size > after) and (e + 1) * size <= until)

    def _summaries(self) -> dict[int, Stretch]:
        """All panes, those of readings within the lateness included."""
        found = {}
        for (pane,), (count, head, tail, sums, newest) in self.panes.iterator():
            found[pane] = Stretch(count, tuple(head), tuple(tail), tuple(sums), newest)
        for pane, times, values in self._by_pane(*self._open()):
            found[pane] = merged(found.get(pane), stretch_of(times, values))
        return found

    def _by_pane(self, times: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        panes, starts = np.unique(times // self.pane_size, return_index=True)
        for pane, own_times, own in zip(panes.tolist(), np.split(times, starts[1:]), np.split(values, starts[1:]), strict=False):
            yield pane, own_times, own

    def _fold(self, until: int) -> None:
        """Take the readings before a time into the summaries of their panes."""
        times, values = self._open()
        count = int(np.searchsorted(times, until, side="left"))
        for pane, own_times, own in self._by_pane(times[:count], values[:count]):
            had = None
            if self.panes.containsKey((pane,)):
                n, head, tail, sums, newest = self.panes.getValue((pane,))
                had = Stretch(n, tuple(head), tuple(tail), tuple(sums), newest)
            now = merged(had, stretch_of(own_times, own))
            self.panes.updateValue((pane,), (now.count, list(now.head), list(now.tail), list(now.sums), now.newest))
        if count:
            self.open.update((times[count:].tolist(), values[count:].tolist()))

    def _fire(self, sensorid: str, ends: list[int]) -> Iterator[pd.DataFrame]:
        if not ends:
            return
        panes, out = self._summaries(), []
        for end in ends:
            window = None
            for pane in range(end - self.windows.panes + 1, end + 1):
                if pane in panes:
                    window = merged(window, panes[pane])
            revision = self.revisions.getValue((end,))[0] + 1 if self.revisions.containsKey((end,)) else 0
            self.revisions.updateValue((end,), (revision,))
            if window is not None and window.count > MIN_HISTORY:
                time = pd.Timestamp(window.newest, unit="us")
                out.append({"sensorid": sensorid, "last_pane": end, "timestamp": time, "revision": revision} | _moments(window))
        if out:
            yield pd.DataFrame({c: [row[c] for row in out] for c in _COLUMNS}, dtype=object)


def forecast_stream(
    readings: DataFrame,
    size: str = "2 hours",
    slide: str = "5 minutes",
    lateness: str = LATENESS,
    disorder: str = DISORDER,
    include_unconverted: bool = False,
    refire: bool = False,
) -> DataFrame:
    """Forecasts of all windows the watermark has closed.

    A window is evaluated once, when readings as late as ``disorder`` plus ``lateness`` have
    had their chance. With ``refire`` it is evaluated when the disorder has passed, and
    again, as the next ``revision``, whenever readings come that are late by no more than
    ``lateness``. Readings later than that, and those without a time, are in no window.
    """
    use_rocksdb(readings.sparkSession)
    windows = Sliding(size, slide)
    delay, late = duration_seconds(disorder), duration_seconds(lateness)
    rows = forecastable(readings, "conValue", include_unconverted).select("sensorid", "timestamp", "conValue")
    rows = rows.where(F.col("timestamp").isNotNull())
    rows = with_event_time(rows, f"{delay if refire else delay + late} seconds")
    # The watermark stays with the query but leaves the column: the state itself tells what is too late.
    rows = rows.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp")))
    fired = rows.groupBy("sensorid").transformWithStateInPandas(
        statefulProcessor=PaneState(windows, late * _SECOND if refire else 0),
        outputStructType=_OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    moments = fired.withColumnRenamed("last_pane", "end").select(
        "sensorid",
        windows.start().alias("window_start"),
        windows.finish().alias("window_end"),
        "timestamp",
        *(["revision"] if refire else []),
        F.col("rows").alias("n"),
        *MOMENTS,
    )
    return estimate(moments)


def forecast_alerts_stream(readings: DataFrame, refire: bool = False, **options) -> DataFrame:
    """Alerts for windows whose last reading left the forecast interval."""
    keep = ("revision",) if refire else ()
    return interval_alerts(forecast_stream(readings, refire=refire, **options), keep=keep)
