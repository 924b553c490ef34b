import pytest
from conftest import at
from pyspark.sql import functions as F

from rivulet.operators import archive
from rivulet.schemas import ALERT, READING, UPDATE
from rivulet.sources import tables

ROWS = "sensorid string, timestamp timestamp, type string, unit string, location string, rawValue double, conValue double"


def measurement(sensor, time, kind):
    return (sensor, time, kind, "mm", "here", 1.0, 2.0)


def test_rows_bind_by_name(spark, rows):
    reading = spark.createDataFrame([("s", at(0), 1.0, "LOC", "TYPE", "UNIT", 2.0, 5)], READING)
    assert rows(archive.to_measurement(reading)) == [
        {"sensorid": "s", "timestamp": 0, "type": "TYPE", "unit": "UNIT", "location": "LOC", "rawValue": 1.0, "conValue": 2.0}
    ]
    alert = spark.createDataFrame([("s", at(0), 25.0, 10.0, 20.0)], ALERT)
    assert rows(archive.to_alarm(alert))[0]["message"] == "Value 25.0 outside of confidence interval by 0.5"
    update = spark.createDataFrame([("s", at(0), "p", "v")], UPDATE)
    assert archive.to_parameter(update).columns == ["sensorid", "timestamp", "parameter", "value"]


def test_many_copies_collapse_before_the_shuffle(spark):
    copies = spark.range(1000).selectExpr(
        "'s' as sensorid", "timestamp_seconds(0) as timestamp", "cast(id as string) as message", "id"
    )
    out = archive.first_wins(copies, archive.ALARM_KEYS, ["id"])
    assert out.collect()[0]["message"] == "0"
    assert archive.last_wins(copies, archive.ALARM_KEYS, ["id"]).collect()[0]["message"] == "999"
    assert "partial_min_by" in out._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def database(spark):
    tables.create_tables(spark, "plant", fresh=True)
    yield "plant"
    spark.sql("DROP DATABASE plant CASCADE")


def test_first_write_wins(spark, rows, database):
    table = f"{database}.measurements"
    first = spark.createDataFrame([measurement("a", at(0), "one"), measurement("b", at(90000), "one")], ROWS)
    again = spark.createDataFrame(
        [measurement("a", at(0), "two"), measurement("a", at(1), "two"), measurement("b", at(90000), "two")], ROWS
    )
    tables.insert_first_wins(first, table)
    tables.insert_first_wins(again, table)
    tables.insert_first_wins(again, table)  # a repeated batch changes nothing
    tables.insert_first_wins(again.limit(0), table)
    assert rows(spark.table(table), "sensorid", "timestamp", "type") == [
        {"sensorid": "a", "timestamp": 0, "type": "one"},
        {"sensorid": "a", "timestamp": 1, "type": "two"},
        {"sensorid": "b", "timestamp": 90000, "type": "one"},
    ]
    assert spark.table(table).select("day").distinct().count() == 2


def test_first_of_a_batch_by_order(spark, rows, database):
    batch = spark.createDataFrame(
        [(2, *measurement("a", at(0), "second")), (1, *measurement("a", at(0), "first"))], "seq int, " + ROWS
    )
    tables.insert_first_wins(batch, f"{database}.measurements", ["seq"])
    assert rows(spark.table(f"{database}.measurements"), "type") == [{"type": "first"}]


def test_last_write_wins(spark, rows, database):
    table = f"{database}.parameters"
    one = spark.createDataFrame([("a", at(0), "type", "one"), ("a", at(0), "unit", "mm")], UPDATE)
    two = spark.createDataFrame([("a", at(0), "type", "two")], UPDATE)
    tables.insert_first_wins(one, table)
    tables.upsert_last_wins(two, table)
    tables.insert_first_wins(one, table)  # the key is stored, whatever its value
    tables.upsert_last_wins(two, table)
    wanted = [
        {"sensorid": "a", "parameter": "type", "value": "two"},
        {"sensorid": "a", "parameter": "unit", "value": "mm"},
    ]
    assert rows(tables.current_rows(spark, table), "sensorid", "parameter", "value") == wanted
    spark.sql("DROP DATABASE IF EXISTS compacted CASCADE")
    tables.compact(spark, table, "compacted.parameters")
    assert spark.table("compacted.parameters").count() == 2
    assert rows(tables.current_rows(spark, "compacted.parameters"), "sensorid", "parameter", "value") == wanted
    spark.sql("DROP DATABASE compacted CASCADE")


def test_create_keeps_rows_and_fresh_drops_them(spark, database):
    row = spark.createDataFrame([("a", at(0), "m")], "sensorid string, timestamp timestamp, message string")
    tables.insert_first_wins(row, f"{database}.alarms")
    tables.create_tables(spark, database)
    assert spark.table(f"{database}.alarms").count() == 1
    tables.create_tables(spark, database, fresh=True)
    assert spark.table(f"{database}.alarms").count() == 0


def test_key_check_reads_only_days_and_keys_of_the_batch(spark, database):
    table = f"{database}.measurements"
    data = [measurement("a", at(86400 * d), "x") for d in range(5)]
    tables.insert_first_wins(spark.createDataFrame(data, ROWS), table)
    stored = spark.table(table).where("day = date'2024-01-02'").select(*archive.MEASUREMENT_KEYS)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "rawValue" not in plan


def test_first_wins_in_the_order_of_the_source(spark, rows, database, tmp_path):
    """However rows are shuffled on the way, the first line of the first file counts."""
    import os
    import time

    from rivulet.operators import decode
    from rivulet.sources.topics import ARRIVAL, Topic, read_topic

    for name, first in (("b", 0), ("a", 500)):  # the later name is the earlier file
        lines = [f'{{"n":"s{i % 20}","t":0,"v":{first + i},"c":1}}' for i in range(500)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines))
        os.utime(tmp_path / f"{name}.txt", (time.time() - 100 + first / 10,) * 2)
    topic = read_topic(spark, Topic("text", str(tmp_path)), streaming=False, arrival=True)
    batch = archive.to_measurement(decode.decode_reading(topic, (ARRIVAL,)), (ARRIVAL,))
    for pieces in (1, 7):
        table = f"{database}.measurements"
        tables.create_tables(spark, database, fresh=True)
        tables.insert_first_wins(batch.orderBy(F.rand(pieces)).repartition(pieces), table, [ARRIVAL])
        assert {r["sensorid"]: r["rawValue"] for r in rows(spark.table(table))} == {f"s{i}": float(i) for i in range(20)}
        tables.create_tables(spark, database, fresh=True)
        tables.upsert_last_wins(batch.orderBy(F.rand(pieces)).repartition(pieces), table, [ARRIVAL])
        assert {r["sensorid"]: r["rawValue"] for r in rows(spark.table(table))} == {f"s{i}": 980.0 + i for i in range(20)}


def test_versions_do_not_come_from_a_clock(spark, rows, database, monkeypatch):
    import time

    table = f"{database}.parameters"
    for step, value in enumerate(("one", "two", "three")):
        monkeypatch.setattr(time, "time_ns", lambda: 10**18 - step * 10**17)  # noqa: B023
        tables.upsert_last_wins(spark.createDataFrame([("a", at(0), "type", value)], UPDATE), table)
    tables.upsert_last_wins(spark.createDataFrame([("a", at(900_000), "type", "other day")], UPDATE), table)
    assert [r["value"] for r in rows(tables.current_rows(spark, table), "timestamp", "value")] == ["three", "other day"]
    assert sorted(r.version for r in spark.table(table).collect()) == [1, 1, 2, 3]
