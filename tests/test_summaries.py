import datetime as dt

from pyspark.sql import functions as F

from apiary.operators import summaries, windows
from apiary.plans import testbed as tb
from support import SF_SMALL


def test_rollup_equals_direct(spark):
    r = tb.readings(spark, SF_SMALL)
    s = tb.sensors(spark, SF_SMALL)
    minute = summaries.sensor_summary(r, 60, sensors=s)
    direct = summaries.sensor_summary(r, 3600, sensors=s)
    rolled = summaries.rollup_sensor_summary(minute, 3600)
    assert sorted(direct.collect()) == sorted(rolled.collect())
    hive_from_minute = summaries.hive_summary(minute).agg(F.sum("value_count")).first()[0]
    assert hive_from_minute == r.count()


def test_half_day_bucket_and_carried_columns(spark):
    rows = [("s1", dt.datetime(2024, 1, 1, 12, 0, 1), "Temperature", 1.0, 3, 4, "w", "1, 2")]
    df = spark.createDataFrame(
        rows, "sensor_id string, time timestamp, sensor_type string, value float, hive int, level int, wing string, latlong string"
    )
    row = summaries.sensor_summary(df, 3600).first()
    assert str(row.bucket_ts) == "2024-01-01 12:00:00" and str(row.time) == "2024-01-01 12:00:00"
    assert (row.hive, row.level, row.wing, row.value_count, row.precision) == (3, 4, "w", 1, 3600)


def test_sliding_windows_cover_each_event_twice(spark):
    r = tb.readings(spark, SF_SMALL)
    w = windows.windowed(r, "time", "2 hours", "1 hour")
    assert w.agg(F.sum("n")).first()[0] == 2 * r.count()
