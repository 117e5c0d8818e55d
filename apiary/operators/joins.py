"""Join of stored readings with the sensors of a recent period.

The stored table is partitioned by ``bucket_date``; the (sensor, day) key of
the join is expressed as a literal day range on the partition column (static
partition pruning, and Parquet row-group pruning on unpartitioned inputs)
plus an equi-join on ``sensor_id``. This is the same set of pairs as joining
each reading with the sensor × day rows of :func:`daily_topology`, without
replicating the dimension once per day. A driving set that is not a plain
day range (some days for some sensors) goes through
:func:`join_daily_topology`, keyed on (``sensor_id``, ``bucket_date``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.operators.strategy import DEFAULT_BROADCAST_ROWS, join_small
from apiary.operators.topology import DEFAULT_DAYS_BACK, day_window

READING_JOIN_COLUMNS = ("sensor_id", "bucket_date", "bucket_ts", "time", "sensor_type", "value")


def in_days(readings: DataFrame, as_of=None, days_back: int = DEFAULT_DAYS_BACK) -> DataFrame:
    """Readings whose day bucket lies in the period (prunes partitions)."""
    first, last = day_window(as_of, days_back)
    return readings.where(F.col("bucket_date").between(first, last))


def sensor_day_join(
    readings: DataFrame,
    sensors: DataFrame,
    as_of=None,
    days_back: int = DEFAULT_DAYS_BACK,
    columns=READING_JOIN_COLUMNS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    salt_buckets: int = 16,
) -> DataFrame:
    """Inner join of the period's readings with the sensor dimension.

    Only ``columns`` of the readings are read (column pruning at the scan).
    The dimension is broadcast when its size check passes; otherwise both
    sides shuffle on ``sensor_id`` with the readings of the commonest sensors
    salted (one job counts them). For two large
    tables stored bucketed by ``sensor_id`` (``apiary.sources.bucketed``)
    pass ``salt_buckets=1``: the join then reads matching buckets in the
    same task, with no shuffle at all (salting would add a key and undo the
    co-location; bucketing suits keys without a hot one, salting suits skew).
    """
    recent = in_days(readings, as_of, days_back).select(*columns)
    dim = sensors.drop(*[c for c in columns if c != "sensor_id" and c in sensors.columns])
    return join_small(
        recent, dim, "sensor_id", "inner", max_rows=max_broadcast_rows, salt_buckets=salt_buckets
    )


def join_stored_topology(
    readings: DataFrame,
    daily: DataFrame,
    columns=("sensor_id", "bucket_date", "value"),
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    salt_buckets: int = 16,
) -> DataFrame:
    """Inner join of a stored readings table with stored (sensor, day) rows.

    Filters on ``daily`` (a wing, a hive) leave some days only. Behind its size
    check ``daily`` is broadcast, and Spark hands the days that are left to the scan of the
    readings (dynamic partition pruning on ``bucket_date``): no job lists them
    beforehand. Only ``columns`` of the readings are joined.
    """
    drive = daily.drop(*[c for c in columns if c not in ("sensor_id", "bucket_date") and c in daily.columns])
    return join_small(
        readings.select(*columns), drive, ["sensor_id", "bucket_date"], "inner",
        max_rows=max_broadcast_rows, salt_buckets=salt_buckets,
    )


def join_daily_topology(
    readings: DataFrame,
    daily: DataFrame,
    columns=READING_JOIN_COLUMNS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    salt_buckets: int = 16,
) -> DataFrame:
    """Inner join of readings with an explicit (sensor, day) driving set.

    A driving set built by ``explode`` carries no filter, so Spark would not
    add dynamic partition pruning; its first and last day (one aggregate
    row of the small side) become a literal range on the partition column
    instead, which prunes the stored table statically.
    """
    span = daily.agg(F.min("bucket_date").alias("lo"), F.max("bucket_date").alias("hi")).first()
    recent = readings.select(*columns)
    if span is not None and span["lo"] is not None:
        recent = recent.where(F.col("bucket_date").between(F.lit(span["lo"]), F.lit(span["hi"])))
    drive = daily.drop(*[c for c in columns if c not in ("sensor_id", "bucket_date") and c in daily.columns])
    return join_small(
        recent,
        drive,
        ["sensor_id", "bucket_date"],
        "inner",
        max_rows=max_broadcast_rows,
        salt_buckets=salt_buckets,
    )
