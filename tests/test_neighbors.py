import random

import pytest
from conftest import at
from pyspark.sql import functions as F

from rivulet.operators import neighbors

CELLS = "reading_id bigint, sensorid string, timestamp timestamp, gridCell bigint, conValue double"


def frame(spark, data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], CELLS)


def naive(data, include_self=True):
    latest, out = {}, []
    for i, (sensor, time, cell, value) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        latest[sensor] = (cell, value)
        members = [v for s, (c, v) in latest.items() if c == cell and (include_self or s != sensor)]
        out.append((i, round(sum(members) / len(members), 6) if members else None))
    return sorted(out)


def random_readings(seed, n=150, hot=False):
    rng = random.Random(seed)
    # Few distinct times make ties, few cells make sensors move and meet.
    return [
        (
            "hot" if hot and rng.random() < 0.6 else rng.choice("abcde"),
            at(rng.randrange(20_000)) if rng.random() < 0.5 else at(3600 * rng.randrange(5)),
            rng.randrange(3),
            rng.randrange(400) / 4,
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seconds", [600, 3_600, 10**9])
@pytest.mark.parametrize("include_self", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_mean_equals_naive(spark, seconds, include_self, seed):
    data = random_readings(seed, hot=seed == 2)
    df = neighbors.neighbor_mean(frame(spark, data), include_self, tie="reading_id", bucket_seconds=seconds)
    got = sorted((r[0], r[1]) for r in df.select("reading_id", F.round("cellMean", 6)).collect())
    assert got == naive(data, include_self)


def test_very_small_and_very_large_values(spark, rows):
    data = [("a", at(0), 1, 2e-7), ("b", at(1), 1, 4e-7), ("c", at(2), 2, 1e17), ("c", at(3), 2, 5.0), ("d", at(4), 1, 1e23)]
    got = {r["reading_id"]: r["cellMean"] for r in rows(neighbors.neighbor_mean(frame(spark, data)), "reading_id", "cellMean")}
    assert got[0] == pytest.approx(2e-7)
    assert got[1] == pytest.approx(3e-7)
    # A large value leaves no trace when it is replaced; one too large to sum is kept without a mean.
    assert (got[2], got[3], got[4]) == (1e17, 5.0, None)


def test_moving_sensor_leaves_its_cell(spark, rows):
    data = [("a", at(0), 1, 10.0), ("b", at(1), 1, 20.0), ("a", at(2), 2, 30.0), ("b", at(3), 1, 40.0)]
    df = neighbors.neighbor_mean(frame(spark, data), tie="reading_id")
    assert [r["cellMean"] for r in rows(df, "reading_id", "cellMean")] == [10.0, 15.0, 30.0, 40.0]


def test_unconverted_and_unlocated_are_left_out(spark, rows):
    data = [
        ("a", at(0), 1, 10.0), ("b", at(1), 1, -99.0), ("c", at(2), 999, 5.0), ("d", at(3), 1, float("nan")),
        ("e", at(4), 1, 20.0),
    ]
    df = frame(spark, data)
    assert [(r["reading_id"], r["cellMean"]) for r in rows(neighbors.neighbor_mean(df), "reading_id", "cellMean")] == [
        (0, 10.0), (3, None), (4, 15.0)
    ]
    every = neighbors.neighbor_mean(df, include_unconverted=True)
    assert {r["reading_id"] for r in rows(every, "reading_id")} == {0, 1, 2, 3, 4}


def test_alerts_bounds_and_strict_threshold(spark, rows):
    data = [("a", at(0), 1, 0.0), ("b", at(1), 1, 20.0), ("c", at(2), 1, 40.0)]
    # Means are 0, 10 and 20: the second deviates by exactly 10, the third by 20.
    assert rows(neighbors.neighbor_alerts(frame(spark, data))) == [
        {"sensorid": "c", "timestamp": 2, "value": 40.0, "lower": 10.0, "upper": 30.0}
    ]
    assert len(rows(neighbors.neighbor_alerts(frame(spark, data), threshold=9.0))) == 2


def test_snapshot(spark, rows):
    data = [("a", at(0), 1, 99.0), ("a", at(5), 1, 10.0), ("b", at(1), 1, 20.0), ("c", at(2), 2, 30.0)]
    got = {r["sensorid"]: r for r in rows(neighbors.neighbor_snapshot(frame(spark, data)))}
    assert (got["a"]["cellMean"], got["a"]["deviation"]) == (20.0, -10.0)
    assert got["c"]["cellMean"] is None
    own = {r["sensorid"]: r for r in rows(neighbors.neighbor_snapshot(frame(spark, data), include_self=True))}
    assert (own["a"]["cellMean"], own["c"]["cellMean"]) == (15.0, 30.0)


def test_cell_latest_follows_the_sensor(spark, rows):
    data = [("a", at(0), 1, 10.0), ("a", at(9), 2, 11.0), ("b", at(1), 1, 20.0)]
    got = rows(neighbors.cell_latest(frame(spark, data)))
    assert [(r["sensorid"], r["gridCell"], r["conValue"]) for r in got] == [("a", 2, 11.0), ("b", 1, 20.0)]


def test_snapshot_aggregates_before_the_shuffle(spark):
    plan = neighbors.neighbor_snapshot(frame(spark, [("a", at(0), 1, 1.0)]))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "partial_sum" in text
    assert "Window" not in text
