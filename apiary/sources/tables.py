"""Stored tables: readings partitioned by UTC day, the sensor dimension.

Tables are Parquet folders read with their fixed schema (never inferred);
the readings table is partitioned by ``bucket_date`` so a day range prunes
folders before any file is opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.operators.upsert import upsert_partitions
from apiary.schemas import HIVE_SUMMARY, READING, READING_KEY, READING_PARTITION, SENSOR, SENSOR_SUMMARY

STORED_READING = T.StructType(READING.fields + [T.StructField(READING_PARTITION, T.DateType())])


def read_readings(spark: SparkSession, path: str, extra: Sequence[T.StructField] = ()) -> DataFrame:
    schema = T.StructType(READING.fields + list(extra) + [T.StructField(READING_PARTITION, T.DateType())])
    return spark.read.schema(schema).parquet(path)


def save_readings(readings: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """Upsert readings into the day-partitioned table (newest per key wins)."""
    upsert_partitions(readings, path, READING_KEY, order_by, READING_PARTITION)


def read_sensors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SENSOR).parquet(path)


def sensors_from_rows(spark: SparkSession, rows) -> DataFrame:
    """A literal dimension (rows of ``SENSOR``), e.g. a hand-made topology."""
    return spark.createDataFrame(rows, SENSOR)


DAILY_SENSOR = T.StructType(
    [
        T.StructField(READING_PARTITION, T.DateType()),
        T.StructField("bucket_ts", T.TimestampType()),
        *SENSOR.fields,
    ]
)


def save_daily_topology(daily: DataFrame, path: str) -> None:
    """Store the (sensor, day) rows of :func:`apiary.operators.topology.daily_topology`."""
    daily.select(*DAILY_SENSOR.fieldNames()).write.mode("overwrite").parquet(path)


def read_daily_topology(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_SENSOR).parquet(path)


# Keys of the summary tables (the declared primary keys, plus sensor type).
SENSOR_SUMMARY_KEY = ("sensor_id", "bucket_ts", "precision", "time", "sensor_type")
HIVE_SUMMARY_KEY = ("hive", "bucket_ts", "precision", "level", "time", "sensor_type")
SUMMARY_PARTITION = "bucket_date"


def _save_summary(summary: DataFrame, path: str, keys, order_col: str) -> None:
    rows = summary.withColumn(SUMMARY_PARTITION, F.to_date("bucket_ts"))
    upsert_partitions(rows, path, keys, [order_col], SUMMARY_PARTITION)


def save_sensor_summary(summary: DataFrame, path: str, run_id: int) -> None:
    """Upsert a sensor summary into its day-partitioned table.

    ``run_id`` orders runs (e.g. the job's start time in seconds): a re-run
    over the same period replaces its rows, newest run winning per key.
    """
    _save_summary(summary.withColumn("run_id", F.lit(run_id).cast("long")), path, SENSOR_SUMMARY_KEY, "run_id")


def save_hive_summary(summary: DataFrame, path: str, run_id: int) -> None:
    _save_summary(summary.withColumn("run_id", F.lit(run_id).cast("long")), path, HIVE_SUMMARY_KEY, "run_id")


def read_sensor_summary(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        SENSOR_SUMMARY.fields
        + [T.StructField("run_id", T.LongType()), T.StructField(SUMMARY_PARTITION, T.DateType())]
    )
    return spark.read.schema(schema).parquet(path)


def read_hive_summary(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        HIVE_SUMMARY.fields
        + [T.StructField("run_id", T.LongType()), T.StructField(SUMMARY_PARTITION, T.DateType())]
    )
    return spark.read.schema(schema).parquet(path)
