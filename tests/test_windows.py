import random

import numpy as np
import pytest
from conftest import START, at
from pyspark.sql import functions as F

from rivulet.operators import forecast, windows
from rivulet.streaming import forecast as stream_forecast

READINGS = "reading_id bigint, sensorid string, timestamp timestamp, conValue double"


def frame(spark, data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], READINGS)


def seconds(time):
    return int((time.replace(tzinfo=START.tzinfo) - START).total_seconds())


def naive_windows(data, size, slide):
    """Readings of every window, by event time and id."""
    out = {}
    for i, (sensor, time, value) in enumerate(data):
        t, epoch = (time - START).total_seconds(), START.timestamp()
        start = (epoch + t) // slide * slide - epoch  # windows align to the epoch
        while start > t - size:
            out.setdefault((sensor, int(start)), []).append((t, i, value))
            start -= slide
    return {k: sorted(v) for k, v in out.items()}


def bursts(seed, n=250, sensors="ab"):
    """Some panes with many readings, some with one, and gaps longer than a window."""
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        base = rng.choice([0, 300, 301, 900, 7000, 40_000, 40_600, 90_000])
        data.append((rng.choice(sensors), at(base + rng.randrange(250)), rng.randrange(1000) / 8))
    return data


SHAPES = [("2 hours", "5 minutes"), ("1 hour", "1 hour"), ("25 minutes", "10 minutes"), ("10 minutes", "25 minutes")]


def spec(text):
    return windows.duration_seconds(text)


@pytest.mark.parametrize(("size", "slide"), SHAPES)
def test_counts_equal_naive(spark, size, slide):
    data = bursts(1)
    got = {
        (r["sensorid"], seconds(r["window_start"])): (r["n"], seconds(r["window_end"]))
        for r in windows.sliding_counts(frame(spark, data), size, slide).collect()
    }
    wanted = {k: (len(v), k[1] + spec(size)) for k, v in naive_windows(data, spec(size), spec(slide)).items()}
    assert got == wanted


def test_counts_equal_built_in_window(spark, rows):
    df = frame(spark, bursts(2))
    built_in = (
        df.groupBy(F.window("timestamp", "2 hours", "5 minutes"), "sensorid").count()
        .select("sensorid", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                F.col("count").alias("n"))
    )
    assert rows(windows.sliding_counts(df)) == rows(built_in)


@pytest.mark.parametrize(("size", "slide"), SHAPES[:3])
def test_history_equals_naive(spark, size, slide):
    data = bursts(3, 120)
    wanted = set()
    for (sensor, start), members in naive_windows(data, spec(size), spec(slide)).items():
        if len(members) > 1:
            for position, (_, i, _) in enumerate(members, 1):
                wanted.add((sensor, start, i, position, len(members), position == len(members)))
    df = windows.window_history_last(frame(spark, data), size, slide, tie="reading_id")
    got = [
        (r["sensorid"], seconds(r["window_start"]), r["reading_id"], r["position"], r["n"], r["is_last"])
        for r in df.collect()
    ]
    assert len(got) == len(set(got))
    assert set(got) == wanted


def naive_forecast(values):
    """Row-wise Hannan-Rissanen estimate of the last value."""
    y, last = np.array(values[:-1]), values[-1]
    if len(y) < forecast.MIN_HISTORY:
        return None
    d = np.diff(y)
    mu = d.mean()
    w = d - mu
    bottom = (w[:-1] ** 2).sum()
    if bottom == 0:
        return None
    a = (w[1:] * w[:-1]).sum() / bottom
    e = np.concatenate([[0.0], w[1:] - a * w[:-1]])
    x1, x2, target = w[1:-1], e[1:-1], w[2:]
    xx, xe, ee = (x1 * x1).sum(), (x1 * x2).sum(), (x2 * x2).sum()
    det = xx * ee - xe * xe
    if det <= forecast.MIN_RELATIVE_DETERMINANT * xx * ee:
        return None
    xy, ey = (x1 * target).sum(), (x2 * target).sum()
    phi, theta = (np.clip(v / det, -0.99, 0.99) for v in (xy * ee - ey * xe, ey * xx - xy * xe))
    residual = target - phi * x1 - theta * x2
    sigma = np.sqrt((residual**2).sum() / (len(target) - 2))
    center = y[-1] + mu + phi * w[-1] + theta * residual[-1]
    return last, center, center - 1.96 * sigma, center + 1.96 * sigma


@pytest.mark.parametrize(("size", "slide"), SHAPES[:3])
def test_forecast_equals_naive(spark, size, slide):
    data = bursts(4)
    wanted = {
        k: naive_forecast([v for _, _, v in members])
        for k, members in naive_windows(data, spec(size), spec(slide)).items()
    }
    wanted = {k: v for k, v in wanted.items() if v}
    df = forecast.arima_forecast(frame(spark, data), size, slide, tie="reading_id")
    got = {
        (r["sensorid"], seconds(r["window_start"])): (r["last"], r["forecast"], r["lower"], r["upper"])
        for r in df.collect()
    }
    assert got.keys() == wanted.keys()
    for key, numbers in wanted.items():
        assert np.allclose(got[key], numbers, rtol=1e-6, atol=1e-6), key


def test_summaries_give_the_same_estimate(spark):
    rng = random.Random(6)
    series = [[rng.randrange(1000) / 8 for _ in range(n)] for n in (7, 8, 12, 40)]
    moments = [stream_forecast._moments(stream_forecast.stretch_of(np.arange(len(v)), np.array(v))) for v in series]
    kinds = ", ".join(["id bigint", "rows bigint", *(f"{m} double" for m in forecast.MOMENTS[1:])])
    df = spark.createDataFrame([(i, *m.values()) for i, m in enumerate(moments)], kinds)
    out = forecast.estimate(df).collect()
    for row in out:
        numbers = (row["last"], row["forecast"], row["lower"], row["upper"])
        assert np.allclose(numbers, naive_forecast(series[row["id"]]))
    assert len(out) == 4


@pytest.mark.parametrize(
    "values", [[1.0], [1.0, 5.0, 2.0, 8.0, 3.0], [4.0] * 20, [float(i) for i in range(20)]], ids=str
)
def test_no_forecast(spark, rows, values):
    data = [("a", at(60 * i), v) for i, v in enumerate(values)]
    assert rows(forecast.arima_forecast(frame(spark, data))) == []


def test_unconverted_readings_are_left_out(spark, rows):
    clean = [("a", at(60 * i), float((i * 7) % 11)) for i in range(20)]
    dirty = clean + [("a", at(60 * i + 1), -99.0) for i in range(20)] + [("a", at(5), float("nan"))]
    columns = ["window_start", F.round("forecast", 6).alias("f"), F.round("upper", 6).alias("u")]
    want = rows(forecast.arima_forecast(frame(spark, clean)), *columns)
    assert rows(forecast.arima_forecast(frame(spark, dirty)), *columns) == want
    assert rows(forecast.arima_forecast(frame(spark, dirty), include_unconverted=True), *columns) != want


def test_alert_on_outlier_only(spark, rows):
    rng = random.Random(7)
    data = [("a", at(60 * i), 20 + rng.uniform(-1, 1)) for i in range(30)]
    quiet = rows(forecast.forecast_alerts(frame(spark, data), "1 hour", "1 hour"))
    data[-1] = ("a", data[-1][1], 500.0)
    [alert] = rows(forecast.forecast_alerts(frame(spark, data), "1 hour", "1 hour"))
    assert quiet == []
    assert (alert["sensorid"], alert["timestamp"], alert["value"]) == ("a", 1740, 500.0)
    assert alert["lower"] < 20 < alert["upper"] < 500


def test_large_outlier_does_not_spoil_other_windows(spark):
    """Sums of a window contain nothing of readings outside it."""
    rng = random.Random(8)
    data = [("a", at(300 * i), 20 + rng.uniform(-1, 1)) for i in range(60)]
    data[10] = ("a", data[10][1], 1e12)
    got = forecast.arima_forecast(frame(spark, data), tie="reading_id").collect()
    members = naive_windows(data, 7200, 300)
    after = [r for r in got if seconds(r["window_start"]) > 3000]
    assert len(after) > 20
    for r in after:
        want = naive_forecast([v for _, _, v in members["a", seconds(r["window_start"])]])
        assert np.allclose((r["forecast"], r["upper"]), (want[1], want[3]))


def test_readings_are_shuffled_once_by_pane(spark):
    df = forecast.arima_forecast(frame(spark, [("a", at(0), 1.0)]), tie="reading_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "collect_list" not in plan
    counts = windows.sliding_counts(frame(spark, [("a", at(0), 1.0)]))
    assert "partial_count" in counts._jdf.queryExecution().executedPlan().toString()
