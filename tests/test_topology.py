import datetime as dt

import pytest
from pyspark.sql import functions as F

from apiary.operators import aggregate, joins, topology
from apiary.schemas import SENSOR

# The three literal sensors of the original batch job (fixed values).
SENSORS = [
    ("9b952907-750c-11e6-834d-1fcfed080ab0", 1, 1, "wing1", "123, 4565", "Temperature"),
    ("9b952907-750c-11e6-834d-2fcfed080ab0", 1, 2, "wing2", "22.798227, 119.9727", "Temperature"),
    ("9b952907-750c-11e6-834d-5fcfed080ab0", 3, 77, "North-West-1G", "22.798227, 119.9727", "Temperature"),
]


@pytest.fixture()
def sensors(spark):
    return spark.createDataFrame(SENSORS, SENSOR)


def readings(spark, rows):
    df = spark.createDataFrame(rows, "sensor_id string, time timestamp, sensor_type string, value float")
    return df.select(
        "sensor_id",
        F.date_trunc("day", "time").alias("bucket_ts"),
        "time",
        "sensor_type",
        "value",
        F.to_date("time").alias("bucket_date"),
    )


def test_daily_topology_has_eight_days(spark, sensors):
    daily = topology.daily_topology(sensors, as_of="2017-01-29")
    rows = daily.collect()
    assert len(rows) == 24
    days = sorted({r.bucket_date for r in rows})
    assert days[0] == dt.date(2017, 1, 22) and days[-1] == dt.date(2017, 1, 29)
    assert {str(r.bucket_ts) for r in rows} == {f"{d} 00:00:00" for d in days}


def test_days_back_parameter(spark, sensors):
    assert topology.daily_topology(sensors, as_of="2017-01-29", days_back=6).count() == 21


def _rows():
    s1, s2, s3 = (s[0] for s in SENSORS)
    return [
        (s1, dt.datetime(2017, 1, 29, 10), "Temperature", 10.0),
        (s2, dt.datetime(2017, 1, 28, 10), "Temperature", 20.0),
        (s3, dt.datetime(2017, 1, 22, 0), "Temperature", 30.0),
        (s3, dt.datetime(2017, 1, 21, 23, 59, 59), "Temperature", 99.0),  # before the period
        (s3, dt.datetime(2017, 1, 30, 0), "Temperature", 99.0),  # after as_of
        ("00000000-0000-0000-0000-000000000000", dt.datetime(2017, 1, 29), "Temperature", 99.0),
    ]


def test_hive_average(spark, sensors):
    joined = joins.sensor_day_join(readings(spark, _rows()), sensors, as_of="2017-01-29")
    got = {r.hive: (r.n, r.total, r.average) for r in aggregate.hive_average(joined).collect()}
    assert got == {1: (2, 30.0, 15.0), 3: (1, 30.0, 30.0)}


def test_keyed_join_equals_range_join(spark, sensors):
    r = readings(spark, _rows())
    a = joins.sensor_day_join(r, sensors, as_of="2017-01-29")
    daily = topology.daily_topology(sensors, as_of="2017-01-29")
    b = joins.join_daily_topology(r, daily)
    cols = ["sensor_id", "time", "value", "hive"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_shuffle_path_and_salting(spark, sensors):
    r = readings(spark, _rows())
    a = joins.sensor_day_join(r, sensors, as_of="2017-01-29", max_broadcast_rows=1, salt_buckets=4)
    b = joins.sensor_day_join(r, sensors, as_of="2017-01-29")
    assert sorted(a.collect()) == sorted(b.select(a.columns).collect())


def test_sensors_seen(spark, sensors):
    seen = topology.sensors_seen(readings(spark, _rows()[:2]), sensors)
    assert {r.hive for r in seen.collect()} == {1}
    assert seen.count() == 2


def test_report_lines(spark):
    df = spark.createDataFrame([(3, 1, 2.5, 2.5)], "hive int, n long, total double, average double")
    assert aggregate.report_lines(df).first().line == "Average for hive 3 = 2.5"


def test_fixed_sum_is_order_free(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.01, -0.05] * 50
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = df.agg(aggregate.fixed_sum("v").alias("s")).first().s
    b = df.repartition(7).agg(aggregate.fixed_sum("v").alias("s")).first().s
    assert a == b == pytest.approx(sum(vals))


def test_fixed_sum_skips_non_finite(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (2.25,)], "v double")
    assert df.agg(aggregate.fixed_sum("v").alias("s")).first().s == 3.75


def test_salted_join_with_a_hot_sensor_keeps_every_row(spark, sensors):
    from pyspark.sql import functions as F

    hot = SENSORS[0][0]
    others = [s[0] for s in SENSORS[1:]]
    n = 30_000
    # a third of all readings belong to one sensor
    r = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot))
        .otherwise(F.element_at(F.array(*[F.lit(o) for o in others]), (F.col("id") % 2 + 1).cast("int")))
        .alias("sensor_id"),
        (F.lit("2017-01-29 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("id") % 86400)).alias("time"),
        F.lit("Temperature").alias("sensor_type"),
        (F.col("id") % 100).cast("float").alias("value"),
    ).select("sensor_id", F.date_trunc("day", "time").alias("bucket_ts"), "time", "sensor_type", "value",
             F.to_date("time").alias("bucket_date"))
    salted = joins.sensor_day_join(r, sensors, as_of="2017-01-29", max_broadcast_rows=1, salt_buckets=8)
    plain = joins.sensor_day_join(r, sensors, as_of="2017-01-29")
    assert salted.count() == plain.count() == n
    a = {x.hive: (x.n, x.total) for x in aggregate.hive_count_sum(salted).collect()}
    b = {x.hive: (x.n, x.total) for x in aggregate.hive_count_sum(plain).collect()}
    assert a == b
    # the hot sensor's rows are spread over several salts
    salts = r.where(F.col("sensor_id") == hot).select(
        F.pmod(F.xxhash64(*[F.col(c) for c in r.columns]), F.lit(8)).alias("s")
    ).distinct().count()
    assert salts == 8


def test_sums_are_neither_rounded_to_four_decimals_nor_capped(spark):
    small = spark.createDataFrame([(1, 0.00004), (1, 0.00004)], "hive int, value double")
    assert aggregate.hive_count_sum(small).first().total == 0.00008
    large = spark.range(1000).selectExpr("1 as hive", "cast(1e12 as double) as value")
    assert aggregate.hive_count_sum(large).first().total == 1e15


def test_average_leaves_nan_out_of_count_and_sum(spark):
    df = spark.createDataFrame([(1, 10.0), (1, float("nan"))], "hive int, value double")
    row = aggregate.hive_average(df).first()
    assert (row.n, row.total, row.average) == (1, 10.0, 10.0)
