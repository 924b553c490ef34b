"""Forecasts on a stream: mergeable summaries, state bounded by panes, windows that fire again."""

import random

import numpy as np
import pytest
from conftest import START, at
from pyspark.sql import functions as F
from test_streaming import CELLS, run, stream, write

from rivulet.operators import forecast
from rivulet.operators.windows import Sliding
from rivulet.streaming.forecast import PaneState, Stretch, forecast_stream, merged, stretch_of

MS = int(START.timestamp() * 1000)


def plain_sums(y):
    """Sums over all values but the last, of products that have all their values."""
    d = [None, *(b - a for a, b in zip(y, y[1:], strict=False))]
    return [sum(d[i] * d[i - k] for i in range(k + 1, len(y) - 1)) for k in range(3)]


def test_stretches_merge_in_any_cut():
    rng = random.Random(1)
    for _ in range(400):
        y = [rng.gauss(20, 5) for _ in range(rng.randrange(1, 25))]
        cuts = sorted({0, len(y), *(rng.randrange(len(y) + 1) for _ in range(rng.randrange(6)))})
        whole = None
        for a, b in zip(cuts, cuts[1:], strict=False):
            whole = merged(whole, stretch_of(np.arange(a, b), np.array(y[a:b])))
        assert (whole.count, whole.newest) == (len(y), len(y) - 1)
        assert whole.head == tuple(y[:3]) and whole.tail == tuple(y[-5:])
        assert whole.sums == pytest.approx(plain_sums(y), abs=1e-9)


def test_a_far_newest_value_does_not_blur_the_sums():
    y = [1.0, 2.0, 1.5, 1e12]
    parts = [stretch_of(np.array([i]), np.array([v])) for i, v in enumerate(y)]
    whole = None
    for part in parts:
        whole = merged(whole, part)
    assert whole.sums == pytest.approx(plain_sums(y))


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Keyed(dict):
    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.timers = set()

    def getMapState(self, *_):
        return Keyed()

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, time):
        self.timers.add(time)

    def deleteTimer(self, time):
        self.timers.discard(time)


class Now:
    def __init__(self, milliseconds):
        self.milliseconds = milliseconds

    def getCurrentWatermarkInMs(self):
        return self.milliseconds


def drive(state, handle, rows, watermark):
    """One micro-batch of (seconds, value) rows, then the timers that the watermark has passed."""
    import pandas as pd

    out = []
    if rows:
        frame = pd.DataFrame({"timestamp": pd.to_datetime([int(s * 1e6) for s, _ in rows], unit="us"), "conValue": [v for _, v in rows]})
        out += list(state.handleInputRows(("s",), iter([frame]), Now(watermark * 1000)))
    for timer in sorted(t for t in handle.timers if t < watermark * 1000):
        handle.timers.discard(timer)
        out += list(state.handleExpiredTimer(("s",), Now(watermark * 1000), timer))
    return [r for frame in out for r in frame.to_dict("records")]


def test_state_is_bounded_by_panes():
    windows, handle = Sliding("2 hours", "5 minutes"), Handle()
    state = PaneState(windows, 0)
    state.init(handle)
    rng, fired, largest = random.Random(2), 0, 0
    for minute in range(0, 600, 5):
        rows = [(minute * 60 + rng.random() * 300, rng.gauss(0, 1)) for _ in range(500)]
        fired += len(drive(state, handle, rows, minute * 60))
        largest = max(largest, len(state.open.get()[0]))
        assert len(state.panes) <= windows.panes + 1
    # Readings of two micro-batches at most are held, 48,000 are in the windows.
    assert largest <= 1000 and fired > 90 and len(handle.timers) == 1
    drive(state, handle, [], 10**7)
    assert not state.panes and not state.revisions and not len(state.open.get()[0])


def test_a_late_reading_fires_its_windows_again():
    windows, handle = Sliding("1 hour", "5 minutes"), Handle()
    state = PaneState(windows, 180 * 1_000_000)
    state.init(handle)
    rows = [(60.0 * i, float(i * 7 % 5)) for i in range(20)]
    drive(state, handle, rows, 0)
    first = drive(state, handle, [], 1200)
    assert {(r["last_pane"], r["revision"]) for r in first} == {(1, 0), (2, 0), (3, 0)}
    again = drive(state, handle, [(1100.0, 9.0)], 1200)
    assert [(r["last_pane"], r["revision"], r["rows"]) for r in again] == [(3, 1, 21)]
    whole = sorted([*rows, (1100.0, 9.0)])
    plain = stretch_of(np.array([t for t, _ in whole]), np.array([v for _, v in whole]))
    assert [again[0][k] for k in "abc"] == pytest.approx(plain.sums)
    # Later than the lateness: in no window, now or then.
    assert drive(state, handle, [(900.0, 50.0)], 1200) == []
    then = drive(state, handle, [], 1500)
    assert [(r["last_pane"], r["revision"], r["rows"]) for r in then] == [(4, 0, 21)]


def readings(seed, n=160, step=60):
    rng = random.Random(seed)
    rows = [(s, at(step * i + rng.randrange(step)), 1, round(rng.gauss(20, 4), 3)) for s in ("a", "b") for i in range(n)]
    rows += [("quiet", at(30_000 + 10 * i), 1, float(i * i % 7)) for i in range(9)]
    rows += [("a", at(60 * n + 20_000 + i), 1, float(i % 3)) for i in range(8)]  # after a gap
    return sorted(rows, key=lambda r: r[1])


@pytest.mark.parametrize("size,slide,refire", [("30 minutes", "5 minutes", False), ("20 minutes", "8 minutes", False), ("30 minutes", "5 minutes", True)])
def test_stream_equals_batch(spark, rows, tmp_path, size, slide, refire):
    data = readings(3)
    # Out of order within the disorder, over file ends too.
    rng = random.Random(4)
    data.sort(key=lambda r: r[1].timestamp() + rng.random() * 55)
    folder = write(spark, data, CELLS, tmp_path / "f", files=4)
    end = [("zzz", at(900_000), 1, 1.0)]
    write(spark, end, CELLS, tmp_path / "f")
    write(spark, end, CELLS, tmp_path / "f")
    batch = forecast.arima_forecast(spark.read.parquet(folder).where("sensorid <> 'zzz'"), size, slide)
    out = run(spark, forecast_stream(stream(spark, folder, CELLS), size, slide, refire=refire), f"fs_{size[:2]}{slide[0]}{refire}", tmp_path)
    columns = ["sensorid", "window_start", "window_end", "timestamp", "n"]
    columns += [F.round(c, 6).alias(c) for c in ("last", "forecast", "lower", "upper")]
    expected = rows(batch, *columns)
    assert len(expected) > 30
    assert rows(out, *columns) == expected


def test_stream_fires_again(spark, rows, tmp_path):
    data = [("a", at(60 * i), 1, float(i * 7 % 5)) for i in range(30)]
    folder = write(spark, data, CELLS, tmp_path / "late")
    write(spark, [("a", at(1900), 1, 3.0)], CELLS, tmp_path / "late")  # the watermark goes to 1840
    write(spark, [("a", at(1950), 1, 2.0)], CELLS, tmp_path / "late")  # the window that ends at 1800 fires
    write(spark, [("a", at(1790), 1, 8.0), ("a", at(1000), 1, 80.0)], CELLS, tmp_path / "late")
    write(spark, [("b", at(99_000), 1, 3.0)] , CELLS, tmp_path / "late")
    write(spark, [("b", at(99_001), 1, 3.0)] , CELLS, tmp_path / "late")
    out = run(spark, forecast_stream(stream(spark, folder, CELLS), "30 minutes", "10 minutes", refire=True), "again", tmp_path)
    found = {(r["window_end"], r["revision"]): r for r in rows(out.where("sensorid = 'a'"))}
    kept = [*data, ("a", at(1790), 1, 8.0)]
    wanted = forecast.arima_forecast(spark.createDataFrame(kept, CELLS), "30 minutes", "10 minutes")
    wanted = {r["window_end"]: r for r in rows(wanted)}
    assert {k for k in found if k[0] == 1800} == {(1800, 0), (1800, 1)}
    assert found[1800, 0]["n"] == 30 and found[1800, 1]["n"] == 31
    assert found[1800, 1]["forecast"] == pytest.approx(wanted[1800]["forecast"])
    assert all(revision == 0 for end, revision in found if end != 1800)


def test_summary_has_a_fixed_size():
    long = stretch_of(np.arange(100_000), np.random.default_rng(0).normal(size=100_000))
    assert isinstance(long, Stretch) and len(long.head) + len(long.tail) + len(long.sums) == 11
