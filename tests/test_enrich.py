import random

import pytest
from conftest import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivulet.operators import enrich, neighbors
from rivulet.operators.asof import asof_latest

READING = "sensorid string, timestamp timestamp, rawValue double"
UPDATE = "update_id bigint, sensorid string, timestamp timestamp, parameter string, value string"


@pytest.fixture
def enriched(spark, rows):
    def run(readings, updates, seconds=86_400):
        r = spark.createDataFrame(readings, READING)
        u = spark.createDataFrame([(i, *x) for i, x in enumerate(updates)], UPDATE)
        return rows(enrich.enrich_asof(r, u, "update_id", bucket_seconds=seconds))

    return run


def test_never_known(enriched):
    assert enriched([("a", at(0), 1.0)], [("b", at(-5), "type", "x")]) == [
        {
            "sensorid": "a", "timestamp": 0, "rawValue": 1.0, "location": "UNKNOWN", "type": "UNKNOWN",
            "unit": "UNKNOWN", "conValue": -99.0, "gridCell": 999,
        }
    ]


@pytest.mark.parametrize("seconds", [10, 86_400, 10**9])
def test_not_valid_yet(enriched, seconds):
    later = [("a", at(10**6), p, "52,13") for p in ("type", "unit", "geolocation", "cell", "conversion")]
    [row] = enriched([("a", at(0), 1.0)], later, seconds)
    assert (row["type"], row["unit"]) == ("NOPARAM", "NOPARAM")
    assert (row["location"], row["conValue"], row["gridCell"]) == ("UNKNOWN", -99.0, 999)


def test_equal_time_is_not_before(enriched):
    updates = [("a", at(0), "type", "old"), ("a", at(10), "type", "new")]
    got = {r["timestamp"]: r["type"] for r in enriched([("a", at(10), 1.0), ("a", at(11), 1.0)], updates)}
    assert got == {10: "old", 11: "new"}


def test_late_update_lands_in_its_place(enriched):
    updates = [("a", at(20), "type", "second"), ("a", at(0), "type", "first")]
    got = {r["timestamp"]: r["type"] for r in enriched([("a", at(10), 1.0), ("a", at(30), 1.0)], updates)}
    assert got == {10: "first", 30: "second"}


def test_same_key_highest_version_wins(enriched):
    updates = [("a", at(0), "type", "one"), ("a", at(0), "type", "two")]
    assert enriched([("a", at(1), 1.0)], updates)[0]["type"] == "two"


def test_geolocation_beats_cell(enriched):
    both = [("a", at(0), "geolocation", "52.5,13.4"), ("a", at(1), "cell", "7")]
    [row] = enriched([("a", at(5), 1.0)], both)
    assert row["location"] == "52.5,13.4"
    assert row["gridCell"] not in (7, 999)


def test_bad_geolocation_keeps_text_and_falls_back(enriched):
    updates = [("a", at(0), "geolocation", "nowhere"), ("a", at(0), "cell", "7")]
    [row] = enriched([("a", at(5), 1.0)], updates)
    assert (row["location"], row["gridCell"]) == ("nowhere", 7)
    # A later text that does not parse replaces a good one.
    updates = [("a", at(0), "cell", "7"), ("a", at(1), "cell", "seven")]
    assert enriched([("a", at(5), 1.0)], updates)[0]["gridCell"] == 999


def test_conversion_uses_the_curve_of_its_time(enriched):
    updates = [
        ("a", at(0), "conversion", "[(0,0),(10,100)]"),
        ("a", at(10), "conversion", "[(0,0)]"),
        ("a", at(20), "conversion", "[(0,0),(10,20)]"),
    ]
    got = {r["timestamp"]: r["conValue"] for r in enriched([("a", at(t), 5.0) for t in (5, 15, 25)], updates)}
    assert got == {5: 50.0, 15: -99.0, 25: 10.0}
    assert enriched([("a", at(5), 11.0)], updates)[0]["conValue"] == -99.0


def test_other_parameters_and_value_with_separator(enriched):
    updates = [("a", at(0), "color", "red"), ("a", at(0), "unit", "m@3,x")]
    [row] = enriched([("a", at(5), 1.0)], updates)
    assert (row["unit"], row["type"]) == ("m@3,x", "UNKNOWN")


def naive(readings, updates):
    out = []
    for sensor, time, key in readings:
        earlier = [(t, i, v) for i, (s, t, p, v) in enumerate(updates) if (s, p) == (sensor, key) and t < time]
        out.append((sensor, time, key, max(earlier)[2] if earlier else None))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), hot=st.booleans())
def test_lookup_equals_naive(spark, seed, hot):
    """Few distinct times make many ties; a hot sensor is cut into buckets of 10 s."""
    rng = random.Random(seed)
    pick = lambda: "hot" if hot and rng.random() < 0.7 else rng.choice("abc")
    probes = [(pick(), at(rng.randrange(60)), rng.choice("pq")) for _ in range(60)]
    updates = [(pick(), at(rng.randrange(60)), rng.choice("pq"), str(i)) for i in range(40)]
    left = spark.createDataFrame(probes, "sensorid string, timestamp timestamp, parameter string")
    right = spark.createDataFrame(
        [(i, s, t, p, v) for i, (s, t, p, v) in enumerate(updates)], UPDATE
    )
    for seconds in (10, 10**9):
        got = asof_latest(
            left, right, ["sensorid", "parameter"], ["value"], tie="update_id", bucket_seconds=seconds
        )
        pairs = [(r[0], r[1].replace(tzinfo=at(0).tzinfo), r[2], r[3]) for r in got.collect()]
        assert sorted(pairs, key=repr) == naive(probes, updates)


def test_no_job_runs_while_a_query_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    readings = spark.range(10).selectExpr("cast(id as string) as sensorid", "timestamp '2024-01-01' as timestamp", "1.0D as rawValue")
    updates = readings.selectExpr("1 as update_id", "sensorid", "timestamp", "'type' as parameter", "'x' as value")
    rich = enrich.enrich_asof(readings, updates, "update_id")
    neighbors.neighbor_alerts(rich)
    enrich.lookup_asof(readings.selectExpr("sensorid", "timestamp", "'type' as parameter"), updates)
    assert not tracker.getJobIdsForGroup("building")
    rich.count()
    assert tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("seconds", [60, 3_600, 86_400])
def test_buckets_give_the_same_rows(spark, rows, seconds):
    rng = random.Random(5)
    readings = spark.createDataFrame(
        [(rng.choice("ab"), at(rng.randrange(10**6)), rng.uniform(0, 10)) for _ in range(300)], READING
    )
    values = {"type": "t", "unit": "u", "cell": "3", "geolocation": "52.5,13.4", "conversion": "(0,0),(9,9)"}
    updates = spark.createDataFrame(
        [
            (i, rng.choice("abc"), at(rng.randrange(10**6)), p, values[p] if i % 3 else f"bad{i}")
            for i, p in enumerate(rng.choices(list(values), k=200))
        ],
        UPDATE,
    )
    plain = enrich.enrich_asof(readings, updates, "update_id", bucket_seconds=10**9)
    assert rows(enrich.enrich_asof(readings, updates, "update_id", bucket_seconds=seconds)) == rows(plain)


def test_plan_has_no_join_and_aggregates_carried_rows_first(spark, tmp_path):
    for name, schema in (("r", READING), ("u", UPDATE)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    readings, updates = (spark.read.parquet(str(tmp_path / n)) for n in "ru")
    df = enrich.enrich_asof(readings, updates, "update_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # One for the rows, two for the carried ones: per bucket, then per sensor.
    assert plan.count("Exchange hashpartitioning") <= 3
    assert "partial_max" in plan
    assert "Join" not in plan


def test_versions_latest_and_pivot(spark, rows):
    data = [
        (1, "a", at(0), "type", "x"),
        (2, "a", at(10), "type", "y"),
        (3, "a", at(5), "type", "z"),
        (4, "a", at(10), "type", "y2"),
        (5, "a", at(1), "unit", "mm"),
        (6, "b", at(1), "color", "red"),
    ]
    updates = spark.createDataFrame(data, UPDATE)
    versions = {(r["sensorid"], r["parameter"]): r for r in rows(enrich.param_versions(updates, "update_id"))}
    assert versions["a", "type"]["current_value"] == "y2"
    assert versions["a", "type"]["previous_value"] == "z"
    assert versions["a", "unit"]["previous_ts"] is None
    latest = {(r["sensorid"], r["parameter"]): r["value"] for r in rows(enrich.latest_parameters(updates, "update_id"))}
    assert latest == {("a", "type"): "y2", ("a", "unit"): "mm", ("b", "color"): "red"}
    pivot = {r["sensorid"]: r for r in rows(enrich.pivot_attributes(updates, "update_id"))}
    assert (pivot["a"]["type"], pivot["a"]["unit"], pivot["a"]["cell"]) == ("y2", "mm", None)
    assert pivot["b"]["type"] is None


def test_lookup_value(spark, rows):
    updates = spark.createDataFrame([(1, "a", at(0), "type", "x"), (2, "a", at(10), "type", "y")], UPDATE)
    assert rows(enrich.lookup_value(updates, "a", "type", at(10))) == [{"value": "x"}]
    assert rows(enrich.lookup_value(updates, "a", "type", at(0))) == []


def test_rank_limit_runs_before_the_shuffle(spark):
    updates = spark.createDataFrame([(1, "a", at(0), "type", "x")], UPDATE)
    plan = enrich.param_versions(updates)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
