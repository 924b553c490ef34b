"""Whole jobs over file topics."""

import json

import pytest
from conftest import START, at

from rivulet.operators import decode, encode, forecast
from rivulet.schemas import ALERT, UPDATE
from rivulet.session import checkpoint_root
from rivulet.sources import tables
from rivulet.sources.topics import Topic, read_topic, write_topic
from rivulet.streaming import jobs

MS = int(START.timestamp() * 1000)


@pytest.fixture
def topic(tmp_path):
    def make(name, lines=()):
        folder = tmp_path / name
        folder.mkdir()
        if lines:
            (folder / "part-0.txt").write_text("\n".join(lines) + "\n")
        return Topic("text", str(folder))

    return make


def sink(tmp_path, name):
    return Topic("json", str(tmp_path / name))


def finish(queries):
    for query in queries:
        query.awaitTermination(180)
        assert query.exception() is None


def messages(spark, topic):
    rows = spark.read.schema("key string, value string").option("recursiveFileLookup", "true").json(topic.name)
    return [json.loads(r["value"]) for r in rows.collect()]


@pytest.fixture
def database(spark, request):
    name = "db_" + request.node.name.split("[")[0]
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


UPDATES = [
    f'{{"n":"s1","t":{MS},"p":"type","v":"level"}}',
    f'{{"n":"s1","t":{MS},"p":"conversion","v":"[(0,0),(10,100)]"}}',
    f'{{"n":"s1","t":{MS},"p":"cell","v":"7"}}',
]


@pytest.mark.parametrize("from_archive", [False, True], ids=["state", "archive"])
def test_enrichment(spark, topic, tmp_path, database, from_archive):
    updates = topic("updates", UPDATES)
    if from_archive:
        # The history is in the archive before the readings come.
        tables.create_tables(spark, database, tables=["parameters"])
        rows = [("s1", at(0), "type", "level"), ("s1", at(0), "conversion", "[(0,0),(10,100)]"), ("s1", at(0), "cell", "7")]
        tables.upsert_last_wins(spark.createDataFrame(rows, UPDATE), f"{database}.parameters")
    raw = topic("raw", [f'{{"n":"S1","t":{MS // 1000 + 5},"v":4}}', '{"other":1}', "broken"])
    rich, rejects = sink(tmp_path, "rich"), sink(tmp_path, "rejects")
    queries = jobs.run_enrichment(
        spark, raw, updates, rich, database, str(tmp_path / "cp"), initialize=True,
        from_archive=from_archive, rejects=rejects, available_now=True,
    )
    finish(queries)
    seen = [p["observedMetrics"]["packets"] for q in queries for p in q.recentProgress if "packets" in p["observedMetrics"]]
    assert sum(m["rejected"] for m in seen) == 2
    [message] = messages(spark, rich)
    assert message == {
        "n": "s1", "t": MS + 5000, "v": 4.0, "g": "UNKNOWN", "r": 7, "ty": "level", "u": "UNKNOWN", "c": 40.0
    }
    assert tables.current_rows(spark, f"{database}.parameters").count() == 3
    assert spark.read.json(rejects.name).count() == 2


def test_enrichment_cold_start(spark, topic, tmp_path, database):
    tables.create_tables(spark, database)
    rows = [("s1", at(-10), "type", "level"), ("s1", at(-5), "type", "flow")]
    tables.upsert_last_wins(spark.createDataFrame(rows, UPDATE), f"{database}.parameters")
    raw = topic("raw", [f'{{"n":"S1","t":{MS // 1000 + 5},"v":4}}'])
    updates = topic("updates", [f'{{"n":"other","t":{MS},"p":"type","v":"x"}}'])
    rich = sink(tmp_path, "rich")
    finish(
        jobs.run_enrichment(
            spark, raw, updates, rich, database, str(tmp_path / "cp"), cold_start=True, available_now=True
        )
    )
    assert [m["ty"] for m in messages(spark, rich)] == ["flow"]


def test_storage(spark, topic, tmp_path, database, rows):
    reading = f'{{"n":"s1","t":{MS},"v":4,"g":"here","r":7,"ty":"level","u":"mm","c":40}}'
    alert = f'{{"n":"s1","t":{MS},"v":25,"min":10,"max":20}}'
    queries = jobs.run_storage(
        spark,
        topic("rich", [reading, reading, "junk"]),
        topic("updates", UPDATES + UPDATES[:1]),
        topic("alarms", [alert]),
        database,
        str(tmp_path / "cp"),
        fresh=True,
        available_now=True,
    )
    assert len(queries) == 3
    finish(queries)
    assert rows(spark.table(f"{database}.measurements"), "sensorid", "type", "unit", "location", "rawValue", "conValue") == [
        {"sensorid": "s1", "type": "level", "unit": "mm", "location": "here", "rawValue": 4.0, "conValue": 40.0}
    ]
    assert spark.table(f"{database}.parameters").count() == 3
    assert rows(spark.table(f"{database}.alarms"), "message") == [
        {"message": "Value 25.0 outside of confidence interval by 0.5"}
    ]


def test_neighbor(spark, topic, tmp_path):
    lines = [f'{{"n":"s{i}","t":{MS + i},"v":1,"r":7,"c":{v}}}' for i, v in enumerate([0, 20, 40])]
    alarms = sink(tmp_path, "alarms")
    finish(jobs.run_neighbor(spark, topic("rich", lines), alarms, str(tmp_path / "cp"), available_now=True))
    assert messages(spark, alarms) == [{"n": "s2", "t": MS + 2, "v": 40.0, "min": 10.0, "max": 30.0}]


def test_forecast(spark, topic, tmp_path):
    values = [20 + (i * 7 % 13) / 10 for i in range(23)] + [500]
    lines = [f'{{"n":"s1","t":{MS + 300_000 * i},"v":1,"c":{v}}}' for i, v in enumerate(values)]
    rich = topic("rich", lines)
    # A far later reading moves the watermark past all windows.
    with open(f"{rich.name}/part-1.txt", "w") as late:
        late.write(f'{{"n":"s2","t":{MS + 10**9},"v":1,"c":1}}\n')
    alarms = sink(tmp_path, "alarms")
    finish(jobs.run_forecast(spark, rich, alarms, str(tmp_path / "cp"), available_now=True))
    got = sorted((a["t"], a["v"]) for a in messages(spark, alarms))
    readings = decode.decode_reading(spark.createDataFrame([(x,) for x in lines], "value string"))
    batch = forecast.forecast_alerts(readings).selectExpr("unix_millis(timestamp)", "value")
    assert got == sorted(map(tuple, batch.collect()))
    assert (MS + 300_000 * 23, 500.0) in got


def test_repeated_batch_takes_its_place(spark, topic):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    target = Topic("table", "repeated_topic")
    try:
        for batch in (0, 1, 1):
            jobs._send(rows, target, batch)
        assert spark.table("repeated_topic").count() == 4
        assert read_topic(spark, target, streaming=False).columns == ["value"]
    finally:
        spark.sql("DROP TABLE IF EXISTS repeated_topic")


def test_passthrough(spark, topic, tmp_path, database, rows):
    raw = topic("raw", [f'{{"n":"s1","t":{MS // 1000},"v":4,"u":"mm"}}'])
    rich = sink(tmp_path, "rich")
    finish(
        jobs.run_passthrough(spark, raw, rich, database, str(tmp_path / "cp"), latest=False, seed=True, available_now=True)
    )
    [message] = messages(spark, rich)
    assert (message["g"], message["ty"], message["u"], message["c"]) == ("HERE", "WGS_DEV", "mm", 4.0)
    assert rows(spark.table(f"{database}.measurements"), "timestamp", "location", "type", "unit") == [
        {"timestamp": 0, "location": "HERE", "type": "WGS_DEV", "unit": "mm"}
    ]
    # The same raw lines mean the same time in the enrichment job.
    parsed = decode.parse_packets(spark.read.text(raw.name))
    assert rows(parsed, "timestamp") == [{"timestamp": 0}]
    assert message["t"] == MS


def test_restart_continues_where_it_stopped(spark, topic, tmp_path, database):
    """A second run with the same checkpoint handles only new input."""
    raw = topic("raw", [f'{{"n":"s1","t":{MS // 1000},"v":4}}'])
    rich = sink(tmp_path, "rich")
    for expected in (1, 2):
        finish(
            jobs.run_passthrough(spark, raw, rich, database, str(tmp_path / "cp"), latest=False, seed=True, available_now=True)
        )
        assert spark.read.json(rich.name).count() == expected
        assert tables.stored(spark, f"{database}.measurements").count() == expected
        with open(f"{raw.name}/part-1.txt", "w") as more:
            more.write(f'{{"n":"s2","t":{MS // 1000},"v":4}}\n')


def test_round_trip_through_a_table_topic(spark, tmp_path):
    alert = spark.createDataFrame([("s", at(0), 1.0, 2.0, 3.0)], ALERT)
    encode.encode_alert(alert).write.mode("overwrite").saveAsTable("alarm_topic")
    source = Topic("table", "alarm_topic")
    assert read_topic(spark, source, streaming=False).count() == 1
    target = Topic("table", "alarm_copy")
    copied = read_topic(spark, source).selectExpr("'k' as key", "value")
    finish([write_topic(copied, target, str(tmp_path / "cp"), available_now=True)])
    assert spark.table("alarm_copy").count() == 1
    for name in ("alarm_topic", "alarm_copy"):
        spark.sql(f"DROP TABLE {name}")


def test_start_position(monkeypatch):
    """``latest`` becomes the option of the source."""
    from rivulet.sources import topics

    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **options):
            self.seen.update(options)
            return self

        def schema(self, _schema):
            return self

        def load(self, *_path):
            raise StopIteration

    class Session:
        readStream = None

    for source, latest, key, wanted in [
        (Topic("kafka", "raw"), True, "startingOffsets", "latest"),
        (Topic("kafka", "raw"), False, "startingOffsets", "earliest"),
        (Topic("text", "/x"), True, "latestFirst", "true"),
    ]:
        Session.readStream = Reader()
        with pytest.raises(StopIteration):
            topics.read_topic(Session, source, latest)
        assert Session.readStream.seen[key] == wanted


@pytest.mark.parametrize("kind", ["text", "table"])
def test_latest_reads_nothing_of_before(spark, tmp_path, kind):
    """Also after a restart, which goes on from the first start."""
    import time

    name = "latest_topic" if kind == "table" else str(tmp_path / "topic")

    def put(text):
        rows = spark.createDataFrame([(text,)], "value string").coalesce(1)
        if kind == "table":
            rows.write.mode("append").saveAsTable(name)
        else:
            rows.write.mode("append").text(name)
        time.sleep(0.05)

    def run_once(number):
        source = read_topic(spark, Topic(kind, name), latest=True, start=str(tmp_path / "start"))
        copied = source.selectExpr("'k' as key", "value")
        finish([write_topic(copied, Topic("json", str(tmp_path / "out")), str(tmp_path / "cp"), available_now=True)])
        out = spark.read.schema("key string, value string").json(str(tmp_path / "out"))
        return sorted(r.value for r in out.collect())

    try:
        put("old")
        put("older")
        assert run_once(0) == []
        put("new")
        assert run_once(1) == ["new"]
        put("newer")
        assert run_once(2) == ["new", "newer"]
    finally:
        spark.sql("DROP TABLE IF EXISTS latest_topic")


def test_checkpoint_root_is_the_folder_the_session_names(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_command_line():
    from rivulet.__main__ import JOBS, arguments

    job, options = arguments(
        ["storage", "--rich", "kafka:a:b", "--updates", "text:/u", "--alarms", "table:x.y", "--database", "db",
         "--option", "kafka.bootstrap.servers=h:1", "--latest"]
    )
    assert job == "storage"
    assert options["rich"] == Topic("kafka", "a:b", {"kafka.bootstrap.servers": "h:1"})
    assert (options["latest"], options["fresh"], options["interval"]) == (True, False, "600000 milliseconds")
    for name, (function, topics, flags) in JOBS.items():
        accepted = function.__code__.co_varnames[: function.__code__.co_argcount]
        assert {*topics, *flags} <= set(accepted), name
