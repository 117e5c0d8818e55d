"""Sensor dimension and its (sensor, day) driving set.

The dimension has one row per sensor (``apiary.schemas.SENSOR``). The daily
topology crosses each sensor with the day buckets of a period ending at
``as_of``: ``days_back = 7`` gives 8 buckets, today and the 7 days before.
``as_of`` is fixed once per query, so a run cannot straddle midnight.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DAYS_BACK = 7


def as_of_date(as_of: str | dt.date | dt.datetime | None) -> Column:
    """The reference day as a DATE column; ``None`` means today (UTC)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(str(as_of)).cast("date")


def day_window(as_of, days_back: int = DEFAULT_DAYS_BACK) -> tuple[Column, Column]:
    """First and last day (inclusive) of the period."""
    last = as_of_date(as_of)
    return F.date_sub(last, days_back), last


def daily_topology(
    sensors: DataFrame, as_of=None, days_back: int = DEFAULT_DAYS_BACK
) -> DataFrame:
    """One row per sensor and day bucket: ``bucket_date``, ``bucket_ts`` + the sensor."""
    first, last = day_window(as_of, days_back)
    days = sensors.select(
        F.explode(F.sequence(first, last)).alias("bucket_date"), *sensors.columns
    )
    return days.select(
        "bucket_date",
        F.col("bucket_date").cast("timestamp").alias("bucket_ts"),
        *sensors.columns,
    )


def sensors_seen(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Dimension rows of the sensors that occur in ``readings``.

    The distinct ids are deduplicated map-side before the shuffle, so a hot
    sensor costs one row per task, not one per reading.
    """
    ids = readings.select("sensor_id").distinct()
    return sensors.join(ids, "sensor_id", "left_semi")
