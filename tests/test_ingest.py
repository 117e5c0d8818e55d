import json

import pytest
from apiary.operators import ingest

GOOD = {
    "serial_number": "9b952907-750c-11e6-834d-5fcfed080ab0",
    "sensor_snapshot": "2017-01-29 10:11:12.345",
    "floor": 77,
    "hive_num": 3,
    "humidity": 41.5,
    "latitude": 22.798227,
    "longitude": 119.9727,
    "main_history": ["ok"],
    "manuf_date": "2016-05-20 00:00:00.000",
    "movement": 2,
    "retired": False,
    "sensor_type": "Temperature",
    "temperature": 19.25,
    "vendor": "v1",
    "wing": "North-West-1G",
}


def msg(**changes):
    m = dict(GOOD)
    for k, v in changes.items():
        if v is ...:
            m.pop(k)
        else:
            m[k] = v
    return json.dumps(m)


CASES = [
    ("good", msg(), None),
    ("extra", msg(extra_field=1), None),
    ("no_history", msg(main_history=...), None),
    ("retired", msg(retired=True), None),
    ("humidity", msg(sensor_type="Humidity"), None),
    ("movement", msg(sensor_type="Movement"), None),
    ("broken", msg()[:-5], ingest.MALFORMED),
    ("floor_text", msg(floor="seventy"), ingest.MALFORMED),
    ("no_snapshot", msg(sensor_snapshot=...), ingest.MISSING_FIELD),
    ("bad_date", msg(sensor_snapshot="2017-01-29"), ingest.MALFORMED),
    ("pressure", msg(sensor_type="Pressure"), ingest.BAD_SENSOR_TYPE),
    ("abc", msg(serial_number="abc"), ingest.BAD_SENSOR_ID),
]


def messages(spark, cases=CASES):
    return spark.createDataFrame([(k, v) for k, v, _ in cases], "key string, value string")


def test_reasons(spark):
    parsed = ingest.parse_messages(messages(spark))
    got = {r.key: r.reason for r in parsed.select("key", "reason").collect()}
    assert got == {k: reason for k, _, reason in CASES}


def test_good_rows(spark):
    readings = ingest.to_readings(ingest.parse_messages(messages(spark)), keep=["key"]).collect()
    by_key = {r.key: r for r in readings}
    assert set(by_key) == {"good", "extra", "no_history", "retired", "humidity", "movement"}
    g = by_key["good"]
    assert g.sensor_id == GOOD["serial_number"]
    assert g.hive == 3 and g.level == 77 and g.wing == "North-West-1G"
    assert g.value == pytest.approx(19.25)
    assert g.latlong == "22.798227, 119.9727"
    assert str(g.time) == "2017-01-29 10:11:12.345000"
    assert str(g.bucket_ts) == "2017-01-29 00:00:00"
    assert str(g.bucket_date) == "2017-01-29"
    assert by_key["humidity"].value == pytest.approx(41.5)
    assert by_key["movement"].value == pytest.approx(2.0)


def test_quarantine_keeps_text(spark):
    q = ingest.quarantined(ingest.parse_messages(messages(spark))).collect()
    assert {r.key for r in q} == {k for k, _, reason in CASES if reason}
    assert all(r.value for r in q)


@pytest.mark.parametrize("key", ["broken", "no_snapshot", "pressure", "abc"])
def test_strict_mode_fails(spark, key):
    bad = [c for c in CASES if c[0] in ("good", key)]
    df = ingest.readings_from_messages(messages(spark, bad), strict=True)
    with pytest.raises(Exception):
        df.collect()


def test_strict_mode_passes_good(spark):
    good = [c for c in CASES if c[2] is None]
    assert ingest.readings_from_messages(messages(spark, good), strict=True).count() == len(good)


def test_encode_decode_roundtrip(spark):
    readings = ingest.to_readings(ingest.parse_messages(messages(spark)), keep=["key"])
    back = ingest.decode_readings(ingest.encode_readings(readings, keep=["key"]), keep=["key"])
    a = sorted(readings.drop("bucket_date").collect())
    b = sorted(back.collect())
    assert a == b


def test_null_message_is_malformed(spark):
    df = spark.createDataFrame([("k", None)], "key string, value string")
    assert ingest.parse_messages(df).select("reason").first().reason == ingest.MALFORMED
