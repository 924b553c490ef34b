"""Latest values, snapshots and pruned lookups, maintained batch by batch."""

import random
import re
from datetime import date, timedelta

import pytest
from conftest import START, at

from rivulet.operators import enrich
from rivulet.schemas import PARAMETERS, UPDATE
from rivulet.sources import attributes, tables

DAY = 86_400
READING = "sensorid string, timestamp timestamp, rawValue double"
COLUMNS = ("sensorid", "timestamp", "rawValue", "location", "type", "unit", "conValue", "gridCell")


@pytest.fixture
def database(spark, request):
    name = "attr_" + re.sub(r"\W", "_", request.node.name)
    attributes.create_attribute_tables(spark, name)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def updates_of(spark, rows):
    return spark.createDataFrame(rows, UPDATE)


def history(seed, days=12, sensors=4, n=150):
    """Updates in random order of arrival, over some days."""
    rng = random.Random(seed)
    texts = {"geolocation": "52.{},13.4", "cell": "{}", "type": "T{}", "unit": "u{}", "conversion": "[(0,0),({},100)]"}
    keys = {(f"s{rng.randrange(sensors)}", rng.randrange(days * DAY), rng.choice(PARAMETERS)) for _ in range(n)}
    rows = [(s, at(t), p, texts[p].format(rng.randrange(10, 99))) for s, t, p in sorted(keys)]
    rng.shuffle(rows)
    return rows


def batches(rows, k):
    return [rows[i * len(rows) // k : (i + 1) * len(rows) // k] for i in range(k)]


def newest(rows):
    out = {}
    for s, t, p, v in rows:
        if (s, p) not in out or out[s, p][0] <= t:
            out[s, p] = (t, v)
    return {k: v for k, (_, v) in out.items()}


def values(df):
    rows = df.collect()
    found = {(r.sensorid, r.parameter): r.value for r in rows}
    assert len(found) == len(rows)
    return found


def test_latest_values_are_maintained(spark, database):
    seen = []
    for number, rows in enumerate(batches(history(1), 9)):
        seen += rows
        attributes.record_updates(updates_of(spark, rows), database, "q", number)
        assert values(attributes.latest_values(spark, database)) == newest(seen)
        merged = attributes.merge_latest(spark, database, least=3)
        assert merged == (number % 3 == 2)
        assert values(attributes.latest_values(spark, database)) == newest(seen)
    assert spark.table(f"{database}.{attributes.COMMITS}").count() == 3
    assert tables.current_rows(spark, f"{database}.parameters").count() == len(seen)


def test_cold_start_reads_in_proportion_to_sensors(spark, database):
    rows = history(2, days=40, n=600)
    for number, part in enumerate(batches(rows, 6)):
        attributes.record_updates(updates_of(spark, part), database, "q", number)
    attributes.merge_latest(spark, database, least=1)
    scanned = attributes.latest_values(spark, database)
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*piece", plan) and "base-" in plan
    # What the partition filter leaves: one row per sensor and attribute, though history is longer.
    number, base = attributes._base(spark, database)
    read = spark.table(f"{database}.latest_parameters").where(f"piece = '{base}'")
    assert number == 6 and read.count() == len(newest(rows)) == scanned.count()
    assert read.count() < len(rows) / 10


def test_repeated_batches_change_nothing(spark, rows, database):
    one, two = [("a", at(0), "type", "one"), ("a", at(0), "unit", "mm")], [("a", at(0), "type", "two")]
    numbers = [
        attributes.record_updates(updates_of(spark, r), database, "q", b) for b, r in ((0, one), (1, two), (1, two), (0, one))
    ]
    assert numbers == [1, 2, 2, 1]
    wanted = {("a", "type"): "two", ("a", "unit"): "mm"}
    assert values(attributes.latest_values(spark, database)) == wanted
    # Versions are numbers of batches, so a clock that steps back has no part in this.
    assert values(tables.current_rows(spark, f"{database}.parameters")) == wanted
    assert attributes.record_updates(updates_of(spark, one), database, "other", 0) == 3
    assert values(tables.current_rows(spark, f"{database}.parameters"))["a", "type"] == "one"


def test_merge_keeps_what_readers_have_begun_to_read(spark, database):
    for number, rows in enumerate(batches(history(3), 4)):
        attributes.record_updates(updates_of(spark, rows), database, "q", number)
    reader = attributes.latest_values(spark, database)
    before = newest(history(3))
    assert attributes.merge_latest(spark, database, least=2)
    assert values(reader) == before
    attributes.record_updates(updates_of(spark, [("new", at(0), "type", "x")]), database, "q", 9)
    assert attributes.merge_latest(spark, database, least=1)
    assert not attributes.merge_latest(spark, database, least=1)
    assert values(attributes.latest_values(spark, database)) == before | {("new", "type"): "x"}
    left = attributes._partitions(spark, f"{database}.latest_parameters", "piece")
    assert [attributes._number(p) for p in left] == [4, 5, 5]  # two bases and the last delta


def test_merge_that_did_not_finish_does_not_count(spark, database):
    rows = history(4)
    attributes.record_updates(updates_of(spark, rows), database, "q", 0)
    # A base without its row in the table of merges, as a lost driver would leave it.
    junk = updates_of(spark, [("x", at(0), "type", "half")]).selectExpr("sensorid", "parameter", "value", "timestamp", "1L as version")
    attributes._insert(junk, f"{database}.latest_parameters", "piece = 'base-0000000000000000001-0'")
    assert values(attributes.latest_values(spark, database)) == newest(rows)
    assert attributes.merge_latest(spark, database, least=1)
    assert values(attributes.latest_values(spark, database)) == newest(rows)


def readings_of(spark, seed, days=12, n=80):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"s{rng.randrange(6)}", at(rng.randrange(days * DAY)), float(i)) for i in range(n)], READING)


def test_pruned_lookups_equal_whole_history(spark, rows, database):
    """Snapshots in between, and updates that come after the snapshots of later days."""
    changes = history(5)
    first_day = START.date()
    parts = batches(changes, 4)
    for number, part in enumerate(parts):
        attributes.record_updates(updates_of(spark, part), database, "q", number)
        if number == 1:
            for d in (3, 6, 9):
                attributes.make_snapshot(spark, database, first_day + timedelta(days=d))
    readings = readings_of(spark, 6)
    wanted = rows(enrich.enrich_asof(readings, updates_of(spark, changes)), *COLUMNS)
    assert rows(attributes.enrich_from_archive(readings, database), *COLUMNS) == wanted
    attributes.make_snapshot(spark, database, first_day + timedelta(days=6))  # made anew
    for day in (0, 4, 6, 11):
        own = readings.where(f"date(timestamp) = date'{first_day + timedelta(days=day)}'")
        wanted = rows(enrich.enrich_asof(own, updates_of(spark, changes)), *COLUMNS)
        assert rows(attributes.enrich_from_archive(own, database), *COLUMNS) == wanted


def test_a_batch_reads_its_days_and_one_snapshot(spark, database):
    changes = history(7, days=30, n=400)
    attributes.record_updates(updates_of(spark, changes), database, "q", 0)
    first_day = START.date()
    for d in (7, 14, 21, 28):
        attributes.make_snapshot(spark, database, first_day + timedelta(days=d))
    wanted = [first_day + timedelta(days=23)]
    plan = attributes.history_of_days(spark, database, wanted)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-22[^\]]*day#\d+ <= 2024-01-24", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*as_of#\d+ = 2024-01-22", plan)
    read = attributes.history_of_days(spark, database, wanted)
    days = {r.timestamp.date() for r in read.collect()}
    assert read.count() < 400 / 2 and max(days) <= date(2024, 1, 30)
    spans, used = attributes._spans([date(2024, 1, 5), date(2024, 1, 9), date(2024, 1, 12)], [date(2024, 1, 8)])
    assert spans == [(None, date(2024, 1, 5)), (date(2024, 1, 8), date(2024, 1, 12))] and used == [date(2024, 1, 8)]


def test_no_rows(spark, rows, database):
    assert attributes.latest_values(spark, database).count() == 0
    assert not attributes.merge_latest(spark, database, least=0)
    attributes.record_updates(updates_of(spark, []), database, "q", 0)
    readings = spark.createDataFrame([("a", at(0), 1.0)], READING)
    assert [r["type"] for r in rows(attributes.enrich_from_archive(readings, database), *COLUMNS)] == ["UNKNOWN"]
    assert attributes.enrich_from_archive(readings.where("false"), database).count() == 0
