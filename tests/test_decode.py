import json

import pytest
from conftest import START, at

from rivulet.operators import decode, encode, enrich
from rivulet.schemas import ALERT, READING, UPDATE

T0 = int(START.timestamp())


@pytest.fixture
def texts(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def test_raw_split(texts, rows):
    good = ['{"n":"a"}', "{}"]
    bad = ["[1]", "5", "", '{"n":', None]
    valid, rejects = decode.decode_raw(texts(*good, *bad))
    assert {r["value"] for r in rows(valid)} == set(good)
    assert {r["value"] for r in rows(rejects)} == set(bad)


def test_senml(texts, rows):
    df = texts(
        f'{{"n":"S1","t":{T0},"v":2}}',
        f'{{"n":"S2","t":"{T0 + 1}","v":"2.5"}}',
        f'{{"n":"S3","t":{T0}.9,"v":1}}',
    )
    assert rows(decode.parse_packets(df)) == [
        {"sensorid": "s1", "timestamp": 0, "rawValue": 2.0},
        {"sensorid": "s2", "timestamp": 1, "rawValue": 2.5},
        {"sensorid": "s3", "timestamp": 0, "rawValue": 1.0},
    ]


def test_atlas_skips_status_and_keeps_good_entries(texts, rows):
    df = texts(
        '{"externalDeviceId":"DEV","timestamp":"2024-01-01T00:00:10.250Z",'
        '"decoded":{"a":1,"b":"x","c":2,"d":null,"Interrupt_status":1}}'
    )
    assert rows(decode.parse_packets(df)) == [
        {"sensorid": "dev-a", "timestamp": 10.25, "rawValue": 1.0},
        {"sensorid": "dev-c", "timestamp": 10.25, "rawValue": 2.0},
    ]
    rejects = rows(decode.parse_rejects(df), "sensorid", "reason")
    assert rejects == [
        {"sensorid": "dev-b", "reason": "bad_value"},
        {"sensorid": "dev-d", "reason": "missing_field"},
    ]


def test_empty_payload_is_neither_good_nor_bad(texts, rows):
    df = texts(
        '{"externalDeviceId":"D","timestamp":"2024-01-01T00:00:10.250Z","decoded":{}}',
        '{"externalDeviceId":"D","timestamp":"2024-01-01T00:00:10.250Z","decoded":{"Interrupt_status":1}}',
    )
    assert rows(decode.parse_packets(df)) == []
    assert rows(decode.parse_rejects(df)) == []


def test_ttn_keeps_all_entries(texts, rows):
    df = texts(
        '{"hardware_serial":"AB","timestamp":"2024-01-01T00:00:10.000Z",'
        '"payload_fields":{"x":1.5,"Interrupt_status":1}}'
    )
    assert {r["sensorid"] for r in rows(decode.parse_packets(df))} == {"ab-x", "ab-Interrupt_status"}


def test_format_precedence(texts, rows):
    both = f'{{"n":"N","t":{T0},"v":1,"externalDeviceId":"D","hardware_serial":"H"}}'
    null_n = '{"n":null,"externalDeviceId":"D","timestamp":"2024-01-01T00:00:00.000Z","decoded":{"a":1}}'
    assert rows(decode.parse_packets(texts(both)), "sensorid") == [{"sensorid": "n"}]
    # The key decides, even when its value is unusable.
    assert rows(decode.parse_packets(texts(null_n))) == []
    assert rows(decode.parse_rejects(texts(null_n)), "reason") == [{"reason": "missing_field"}]


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ('{"other":1}', "unknown_format"),
        ('{"n":"a","t":', "not_json"),
        (f'{{"n":"a","t":{T0},"v":"x"}}', "bad_value"),
        ('{"n":"a","t":"soon","v":1}', "bad_time"),
        ('{"n":"a","t":99999999999999999,"v":1}', "bad_time"),
        ('{"n":"a","v":1}', "missing_field"),
        ('{"externalDeviceId":"D","timestamp":"yesterday","decoded":{"a":1}}', "bad_time"),
        ('{"externalDeviceId":"D","timestamp":"2024-01-01T00:00:00.000Z"}', "missing_field"),
        ('{"hardware_serial":"D","payload_fields":{"a":1}}', "missing_field"),
        ('{"hardware_serial":"D","timestamp":"2024-01-01T00:00:00.000Z","payload_fields":[1]}', "missing_field"),
    ],
)
def test_rejects(texts, rows, text, reason):
    assert rows(decode.parse_packets(texts(text))) == []
    assert rows(decode.parse_rejects(texts(text)), "reason") == [{"reason": reason}]


def test_packet_times_are_utc_in_any_session_zone(spark, texts):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = texts('{"hardware_serial":"D","timestamp":"2024-01-01T00:00:10.000Z","payload_fields":{"a":1}}')
        seconds = decode.parse_packets(df).selectExpr("unix_seconds(timestamp)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == T0 + 10


def test_parsing_scans_the_source_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("{}",)], "value string").write.parquet(path)
    plan = decode.parse_packets(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan


def test_reading_defaults(texts, rows):
    out = rows(decode.decode_reading(texts(f'{{"n":"a","t":{T0 * 1000 + 1500},"v":1}}', '{"n":"a","v":1}', "x")))
    assert out == [
        {
            "sensorid": "a", "timestamp": 1.5, "rawValue": 1.0, "location": "UNKNOWN", "type": "UNKNOWN",
            "unit": "UNKNOWN", "conValue": -99.0, "gridCell": 999,
        }
    ]


def test_update_needs_all_fields(texts, rows):
    df = texts(
        f'{{"n":"a","t":{T0 * 1000},"p":"unit","v":"m@m, \\"x"}}',
        f'{{"n":"a","t":{T0 * 1000},"p":"unit"}}',
        '{"n":"a","p":"unit","v":"mm"}',
    )
    assert rows(decode.decode_update(df)) == [
        {"sensorid": "a", "timestamp": 0, "parameter": "unit", "value": 'm@m, "x'}
    ]


def test_round_trips(spark, rows):
    readings = spark.createDataFrame([('s"1', at(1.25), 0.1, "52,13", "t", "u", -99.0, 2**62)], READING)
    updates = spark.createDataFrame([("s", at(2), "conversion", "[(0,0),(1,2)]")], UPDATE)
    alerts = spark.createDataFrame([("s", at(3), 1e-7, -1.5, 2.5e10)], ALERT)
    assert rows(decode.decode_reading(encode.encode_reading(readings))) == rows(readings)
    assert rows(decode.decode_update(encode.encode_update(updates))) == rows(updates)
    assert rows(decode.decode_alert(encode.encode_alert(alerts))) == rows(alerts)


def test_wire_keys(spark):
    readings = spark.createDataFrame([("s", at(1), 0.5, "g", "t", "u", 1.5, 7)], READING)
    key, value = encode.encode_reading(readings).first()
    assert key == "s"
    assert json.loads(value) == {
        "n": "s", "t": (T0 + 1) * 1000, "v": 0.5, "g": "g", "r": 7, "ty": "t", "u": "u", "c": 1.5
    }


def test_fake_enrich(spark, rows):
    df = spark.createDataFrame([("s", at(1), 0.5)], "sensorid string, timestamp timestamp, rawValue double")
    assert rows(enrich.fake_enrich(df), "location", "type", "unit", "conValue", "gridCell") == [
        {"location": "HERE", "type": "WGS_DEV", "unit": "UNKNOWN", "conValue": 0.5, "gridCell": 999}
    ]
