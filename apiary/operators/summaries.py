"""Per-sensor and per-hive summaries at minute and hour precision.

A summary row holds the sum and count of values for one sensor (or one hive
and level) and sensor type in one period; ``bucket_ts`` is the half-day the
period lies in (the table's partition key), ``precision`` the period length
in seconds. Readings are aggregated first and the sensor attributes joined
after, on the much smaller aggregate. Coarser summaries are built from finer
ones (sum of sums, sum of counts), exactly, as sums are fixed point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.functions.buckets import bucket
from apiary.operators.aggregate import finite, fixed_sum
from apiary.operators.strategy import join_small

# Precision in seconds and the calendar unit of each (fixed values).
PRECISION_UNITS: dict[int, str] = {60: "minute", 3600: "hour"}

SENSOR_ATTRS = ("hive", "level", "wing", "latlong")
SUMMARY_COLUMNS = (
    "sensor_id", "bucket_ts", "precision", "time", "hive", "level", "wing",
    "sensor_type", "latlong", "value_sum", "value_count",
)
HIVE_COLUMNS = (
    "hive", "bucket_ts", "precision", "level", "time", "sensor_type", "value_sum", "value_count",
)


def _unit(precision: int) -> str:
    if precision not in PRECISION_UNITS:
        raise ValueError(f"precision must be one of {sorted(PRECISION_UNITS)}, not {precision}")
    return PRECISION_UNITS[precision]


def sensor_summary(
    readings: DataFrame,
    precision: int = 60,
    sensors: DataFrame | None = None,
    exact: bool = True,
) -> DataFrame:
    """Sum and count per sensor, type and period.

    Sensor attributes come from ``sensors`` when given (left join, so a
    reading of an unknown sensor keeps null attributes), else from the
    readings' own columns.
    """
    unit = _unit(precision)
    carried = [] if sensors is not None else [c for c in SENSOR_ATTRS if c in readings.columns]
    agg = readings.groupBy(
        "sensor_id",
        "sensor_type",
        bucket("time", "half_day").alias("bucket_ts"),
        bucket("time", unit).alias("time"),
        *carried,
    ).agg(fixed_sum("value", exact).alias("value_sum"), F.count(finite("value")).alias("value_count"))
    agg = agg.withColumn("precision", F.lit(precision))
    if sensors is not None:
        agg = join_small(agg, sensors.select("sensor_id", *SENSOR_ATTRS), "sensor_id", "left")
    for c in SENSOR_ATTRS:
        if c not in agg.columns:
            agg = agg.withColumn(c, F.lit(None))
    return agg.select(*SUMMARY_COLUMNS)


def rollup_sensor_summary(
    summary: DataFrame, precision: int = 3600, exact: bool = True
) -> DataFrame:
    """A coarser sensor summary from a finer one."""
    unit = _unit(precision)
    return (
        summary.groupBy(
            "sensor_id", "bucket_ts", bucket("time", unit).alias("time"), "hive", "level", "wing",
            "sensor_type", "latlong",
        )
        .agg(
            fixed_sum("value_sum", exact).alias("value_sum"),
            F.sum("value_count").alias("value_count"),
        )
        .withColumn("precision", F.lit(precision))
        .select(*SUMMARY_COLUMNS)
    )


def hive_summary(summary: DataFrame, exact: bool = True) -> DataFrame:
    """Per hive, level, type and period, from a sensor summary."""
    return (
        summary.groupBy("hive", "bucket_ts", "precision", "level", "time", "sensor_type")
        .agg(
            fixed_sum("value_sum", exact).alias("value_sum"),
            F.sum("value_count").alias("value_count"),
        )
        .select(*HIVE_COLUMNS)
    )


def summary_from_windows(
    windows: DataFrame, precision: int, sensors: DataFrame | None = None
) -> DataFrame:
    """Sensor summary rows from per-(sensor, type) window totals of a stream.

    ``windows`` holds ``window_start``, ``sensor_id``, ``sensor_type``, ``n``
    and ``total`` (e.g. :func:`apiary.streaming.windows.read_windows`); the
    windows must be ``precision`` seconds long.
    """
    _unit(precision)
    rows = windows.select(
        "sensor_id",
        "sensor_type",
        bucket("window_start", "half_day").alias("bucket_ts"),
        F.col("window_start").alias("time"),
        F.col("total").alias("value_sum"),
        F.col("n").alias("value_count"),
        F.lit(precision).alias("precision"),
    )
    if sensors is not None:
        rows = join_small(rows, sensors.select("sensor_id", *SENSOR_ATTRS), "sensor_id", "left")
    for c in SENSOR_ATTRS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None))
    return rows.select(*SUMMARY_COLUMNS)
