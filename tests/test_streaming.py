"""Streams give what the batch forms give."""

from conftest import at
from pyspark.sql import functions as F

import numpy as np
import pytest

from rivulet.operators import enrich, forecast, neighbors
from rivulet.sources import attributes
from rivulet.streaming.enrich import Versions, enrich_batch, enrich_stream, finish_batch, lookup_stream
from rivulet.streaming.forecast import forecast_stream
from rivulet.streaming.neighbors import neighbor_mean_stream
from rivulet.streaming.time import with_event_time

READING = "sensorid string, timestamp timestamp, rawValue double"
UPDATE = "sensorid string, timestamp timestamp, parameter string, value string"


def write(spark, rows, schema, folder, files=1):
    """Rows as parquet, in ``files`` files that a stream reads one by one."""
    for i in range(files):
        part = rows[i * len(rows) // files:(i + 1) * len(rows) // files]
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, df, name, tmp_path, mode="append"):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(180)
    assert query.exception() is None
    return spark.table(name)


READINGS = [("a", at(10 * i + 5), float(i)) for i in range(20)] + [("b", at(10 * i + 5), 2.0 * i) for i in range(20)]
UPDATES = [
    ("a", at(0), "type", "level"),
    ("a", at(50), "type", "flow"),
    ("a", at(0), "unit", "mm"),
    ("a", at(20), "conversion", "[(0,0),(10,100)]"),
    ("a", at(0), "geolocation", "52.5,13.4"),
    ("a", at(120), "cell", "7"),
    ("b", at(0), "cell", "5"),
]
COLUMNS = ["sensorid", "timestamp", "rawValue", "location", "type", "unit", "conValue", "gridCell"]


def unknown(records):
    """A stream cannot tell not-yet-valid from never-known before an update arrives."""
    return [{k: "UNKNOWN" if v == "NOPARAM" else v for k, v in r.items()} for r in records]


def test_enrich_stream_equals_batch(spark, rows, tmp_path):
    r = write(spark, READINGS, READING, tmp_path / "r")
    u = write(spark, UPDATES, UPDATE, tmp_path / "u")
    expected = enrich.enrich_asof(spark.read.parquet(r), spark.read.parquet(u))
    out = run(spark, enrich_stream(stream(spark, r, READING), stream(spark, u, UPDATE)), "e1", tmp_path)
    assert unknown(rows(out, *COLUMNS)) == unknown(rows(expected, *COLUMNS))


def test_enrich_stream_waits_for_late_updates(spark, rows, tmp_path):
    # Updates arrive in a later micro-batch than the readings they apply to.
    r = write(spark, READINGS + [("z", at(100000), 0.0)], READING, tmp_path / "r")
    late = [("x", at(0), "type", "none")]
    u = write(spark, late, UPDATE, tmp_path / "u")
    write(spark, UPDATES, UPDATE, tmp_path / "u")
    write(spark, [("z", at(100000), "type", "end")], UPDATE, tmp_path / "u")
    batch = enrich.enrich_asof(spark.read.parquet(r), spark.read.parquet(u)).where("sensorid <> 'z'")
    timed = enrich_stream(
        with_event_time(stream(spark, r, READING), "1 day"),
        with_event_time(stream(spark, u, UPDATE), "1 day"),
        wait_for_watermark=True,
    )
    out = run(spark, timed, "e2", tmp_path)
    # The watermark is still a day back here: nothing may have come out too early.
    assert {r["sensorid"] for r in rows(out, *COLUMNS)} <= {r["sensorid"] for r in rows(batch, *COLUMNS)}

    timed = enrich_stream(
        with_event_time(stream(spark, r, READING), "60 seconds"),
        with_event_time(stream(spark, u, UPDATE), "60 seconds"),
        wait_for_watermark=True,
    )
    out = run(spark, timed, "e3", tmp_path)
    assert unknown(rows(out.where("sensorid <> 'z'"), *COLUMNS)) == unknown(rows(batch, *COLUMNS))


def test_enrich_stream_cold_start(spark, rows, tmp_path):
    r = write(spark, READINGS, READING, tmp_path / "r")
    u = write(spark, [("q", at(0), "type", "x")], UPDATE, tmp_path / "u")
    history = spark.createDataFrame(
        [("a", at(-100), "type", "old"), ("a", at(-50), "type", "level"), ("b", at(1000), "type", "later")], UPDATE
    )
    initial = enrich.latest_parameters(history)
    out = run(spark, enrich_stream(stream(spark, r, READING), stream(spark, u, UPDATE), initial), "e4", tmp_path)
    types = {(x["sensorid"], x["type"]) for x in rows(out, *COLUMNS)}
    assert types == {("a", "level"), ("b", "NOPARAM")}


def test_enrich_stream_across_batches(spark, rows, tmp_path):
    """State carries attributes into later micro-batches."""
    r = write(spark, sorted(READINGS, key=lambda x: x[1]), READING, tmp_path / "r", files=3)
    u = write(spark, UPDATES, UPDATE, tmp_path / "u")
    expected = enrich.enrich_asof(spark.read.parquet(r), spark.read.parquet(u))
    out = run(spark, enrich_stream(stream(spark, r, READING), stream(spark, u, UPDATE)), "e5", tmp_path)
    assert unknown(rows(out, *COLUMNS)) == unknown(rows(expected, *COLUMNS))


def test_enrich_stream_keeps_old_versions(spark, rows, tmp_path):
    """A reading may come however late, also after one with a clock far ahead."""
    day = 86400
    old = [("a", at(0), "type", "v0"), ("a", at(10 * day), "type", "v10"), ("a", at(20 * day), "type", "v20")]
    data = [("a", at(30 * day), 1.0), ("a", at(9000 * day), 2.0), ("a", at(3 * day), 3.0), ("a", at(15 * day), 4.0)]
    u = write(spark, old, UPDATE, tmp_path / "u")
    r = write(spark, data, READING, tmp_path / "r", files=4)
    expected = enrich.enrich_asof(spark.read.parquet(r), spark.read.parquet(u))
    out = run(spark, enrich_stream(stream(spark, r, READING), stream(spark, u, UPDATE)), "e6", tmp_path)
    assert rows(out, *COLUMNS) == rows(expected, *COLUMNS)
    assert {x["rawValue"]: x["type"] for x in rows(out, *COLUMNS)} == {1.0: "v20", 2.0: "v20", 3.0: "v0", 4.0: "v10"}


def test_enrich_stream_takes_rows_behind_the_watermark(spark, rows, tmp_path):
    r, u = tmp_path / "r", tmp_path / "u"
    write(spark, [("z", at(100000), 0.0)], READING, r)
    write(spark, [("z", at(99000), "type", "end")], UPDATE, u)
    # Far behind the watermark by now; the update comes first.
    write(spark, [("z", at(100000), 0.0)], READING, r)
    write(spark, [("a", at(1), "type", "late")], UPDATE, u)
    write(spark, [("a", at(5), 7.0)], READING, r)
    write(spark, [("a", at(0), "unit", "mm")], UPDATE, u)
    write(spark, [("z", at(200000), 0.0)], READING, r)
    timed = enrich_stream(
        with_event_time(stream(spark, str(r), READING), "60 seconds"),
        with_event_time(stream(spark, str(u), UPDATE), "60 seconds"),
        wait_for_watermark=True,
    )
    out = run(spark, timed, "e7", tmp_path).where("sensorid = 'a'")
    expected = enrich.enrich_asof(spark.read.parquet(str(r)), spark.read.parquet(str(u))).where("sensorid = 'a'")
    assert rows(out, *COLUMNS) == rows(expected, *COLUMNS)
    assert [x["type"] for x in rows(out, *COLUMNS)] == ["late"]


def test_enrich_stream_cold_start_with_all_versions(spark, rows, tmp_path):
    history = [("a", at(-100), "type", "old"), ("a", at(50), "type", "level")]
    r = write(spark, READINGS, READING, tmp_path / "r")
    u = write(spark, [("q", at(0), "type", "x")], UPDATE, tmp_path / "u")
    initial = spark.createDataFrame(history, UPDATE)
    expected = enrich.enrich_asof(spark.read.parquet(r), initial)
    out = run(spark, enrich_stream(stream(spark, r, READING), stream(spark, u, UPDATE), initial), "e8", tmp_path)
    assert rows(out, *COLUMNS) == rows(expected, *COLUMNS)


def test_enrich_batch_against_archive(spark, rows):
    readings = spark.createDataFrame(READINGS, READING)
    updates = spark.createDataFrame(UPDATES, UPDATE)
    expected = enrich.enrich_asof(readings, updates)
    assert rows(enrich_batch(readings, updates), *COLUMNS) == rows(expected, *COLUMNS)


class CountedMap(dict):
    """A map state in memory that counts what is read."""

    reads = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        self.reads += 1
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


def test_lookups_read_two_buckets_of_a_long_history():
    buckets, index = CountedMap(), CountedMap()
    versions = Versions(buckets, index, 100, None)
    versions.add("type", [(t, f"v{t}") for t in range(0, 100_000, 10)])
    buckets.reads = 0
    texts, beyond, known = versions.before("type", np.array([50_000, 50_055]))
    assert texts.tolist() == ["v49990", "v50050"] and not beyond.any() and known
    assert buckets.reads == 2 and len(buckets) == 1000
    # An update reads and writes its own bucket only.
    versions.add("type", [(70_001, "new")])
    assert buckets.reads == 3 and index.reads == 2
    assert versions.before("type", np.array([70_002, 0, 1]))[0].tolist() == ["new", None, "v0"]


def test_bounded_versions_tell_what_lies_beyond():
    versions = Versions(CountedMap(), CountedMap(), 100, 3)
    for t in range(0, 1000, 50):
        versions.add("type", [(t, f"v{t}")])
    assert len(versions.buckets) == 3
    texts, beyond, known = versions.before("type", np.array([10, 700, 701, 1000]))
    assert texts.tolist() == [None, None, "v700", "v950"] and beyond.tolist() == [True, True, False, False] and known
    versions.add("type", [(650, "late")])  # older than what is held: the archive has it
    assert versions.before("type", np.array([701, 660]))[1].tolist() == [False, True]
    assert versions.before("unit", np.array([5]))[1:] == (np.array([False]), False)


@pytest.mark.parametrize("cold", [False, True])
def test_bounded_stream_with_archive_equals_batch(spark, rows, tmp_path, cold):
    """Readings of any age, over state of two days and the archive."""
    database, day = f"bounded_{cold}".lower(), 86400
    attributes.create_attribute_tables(spark, database)
    try:
        before = [("a", at(-5 * day), "type", "old"), ("a", at(-2 * day), "type", "older"), ("b", at(-3 * day), "unit", "m")]
        news = [("a", at(d * day + 60), p, f"{p}{d}") for d in range(10) for p in ("type", "unit")]
        news.insert(15, ("a", at(day + 500), "type", "late"))
        late = [("a", at(d * day + s), float(d)) for d in (9, 1, 0, 4, -1, 7) for s in (0, 600)] + [("b", at(5), 1.0)]
        u = write(spark, news, UPDATE, tmp_path / "u", files=3)
        r = write(spark, [("z", at(0), 0.0)] * 3, READING, tmp_path / "r", files=3)
        write(spark, late, READING, tmp_path / "r", files=2)
        initial = None
        if cold:
            attributes.record_updates(spark.createDataFrame(before, UPDATE), database, "before", 0)
            initial = attributes.latest_values(spark, database)
        every = spark.createDataFrame(news + (before if cold else []), UPDATE)
        expected = enrich.enrich_asof(spark.read.parquet(r), every).where("sensorid <> 'z'")
        out, marked = [], []

        def finish(batch, number):
            batch = batch.persist()
            updates = batch.where("parameter is not null").select("sensorid", "timestamp", "parameter", "value")
            attributes.record_updates(updates, database, "stream", number)
            marked.append(batch.where("beyond").count())
            out.extend(rows(finish_batch(batch, database).where("sensorid <> 'z'"), *COLUMNS))
            batch.unpersist()

        looked_up = lookup_stream(
            stream(spark, r, READING), stream(spark, u, UPDATE), initial,
            keep_buckets=2, initial_is_complete=False, pass_updates_on=True,
        )
        query = looked_up.writeStream.foreachBatch(finish).option("checkpointLocation", str(tmp_path / "cp"))
        query = query.trigger(availableNow=True).start()
        query.awaitTermination(240)
        assert query.exception() is None
        assert sum(marked) >= 5
        key = lambda r: [repr(v) for v in r.values()]
        assert unknown(sorted(out, key=key)) == unknown(rows(expected, *COLUMNS))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


CELLS = "sensorid string, timestamp timestamp, gridCell bigint, conValue double"


def test_neighbor_stream_equals_batch(spark, rows, tmp_path):
    data = [
        # Neighbouring cell ids of this size are equal as floats.
        (f"s{i % 5}", at(i * 7), 2**61 + (i // 11 + i % 5) % 3, float((i * 37) % 50) / 4)
        for i in range(60)
    ]
    folder = write(spark, data, CELLS, tmp_path / "c", files=3)
    batch = neighbors.neighbor_mean(spark.read.parquet(folder))
    out = run(spark, neighbor_mean_stream(stream(spark, folder, CELLS)), "n1", tmp_path)
    columns = ["sensorid", "timestamp", "gridCell", "conValue", F.round("cellMean", 9).alias("mean")]
    assert rows(out, *columns) == rows(batch, *columns)


def test_neighbor_stream_compares_late_readings(spark, rows, tmp_path):
    first = [("a", at(1000), 1, 10.0), ("b", at(1000), 1, 30.0)]
    folder = write(spark, first, CELLS, tmp_path / "late")
    write(spark, [("a", at(0), 1, 50.0)], CELLS, tmp_path / "late")
    write(spark, [("b", at(2000), 1, 40.0)], CELLS, tmp_path / "late")
    out = run(spark, neighbor_mean_stream(stream(spark, folder, CELLS)), "n2", tmp_path)
    means = {(r["sensorid"], r["timestamp"]): r["cellMean"] for r in rows(out, "sensorid", "timestamp", "cellMean")}
    assert means == {("a", 1000): 10.0, ("b", 1000): 20.0, ("a", 0): 20.0, ("b", 2000): 25.0}


def test_forecast_stream_equals_batch(spark, rows, tmp_path):
    data = [
        (s, at(300 * i + k), None, 20.0 + ((i * (7 + k)) % 13) * 1.5)
        for k, s in enumerate(("a", "b"))
        for i in range(40)
    ]
    data = [(s, t, 1, v) for s, t, _, v in data]
    end = [("zzz", at(900000), 1, 1.0)]
    folder = write(spark, sorted(data, key=lambda x: x[1]), CELLS, tmp_path / "f", files=3)
    write(spark, end, CELLS, tmp_path / "f")
    # One more file, so that a batch runs after the watermark has moved.
    write(spark, end, CELLS, tmp_path / "f")
    batch = forecast.arima_forecast(spark.read.parquet(folder).where("sensorid <> 'zzz'"))
    out = run(spark, forecast_stream(stream(spark, folder, CELLS)), "f1", tmp_path)
    columns = ["sensorid", "window_start", "window_end", "timestamp", "n"] + [
        F.round(c, 6).alias(c) for c in ("last", "forecast", "lower", "upper")
    ]
    expected = rows(batch, *columns)
    assert len(expected) > 50
    assert rows(out, *columns) == expected
