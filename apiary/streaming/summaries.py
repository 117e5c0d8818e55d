"""Summaries kept by streams: minutes into hours, and per hive with the dimension.

* :func:`start_sensor_hours`: two stateful windows in one query. Minute sums per
  sensor and type are closed by the watermark, their ``window_time`` carries them
  into hour sums, and each hour is written once, final.
* :func:`start_hive_summary`: a stream joined to the sensor dimension. Every
  micro-batch reads the dimension as it is then, joins its own readings, and writes
  its sums per hive, level, type and minute; sums of several batches are added
  on reading. A reading is counted under the attributes its sensor had when it
  arrived, a later change of the dimension moves no earlier reading, and no
  state is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apiary.operators.aggregate import finite, fixed_sum
from apiary.operators.summaries import HIVE_COLUMNS, hive_summary, sensor_summary
from apiary.operators.windows import with_watermark
from apiary.schemas import HIVE_SUMMARY

SENSOR_KEYS = ("sensor_id", "sensor_type")


def hours_from_minutes(stream: DataFrame, keys: Sequence[str] = SENSOR_KEYS, delay: str = "1 hour") -> DataFrame:
    """(window_start, window_end, keys, n, total) per hour, from minute sums of the same stream."""
    minutes = (
        with_watermark(stream, "time", delay)
        .groupBy(F.window("time", "1 minute").alias("_minute"), *keys)
        .agg(F.count(finite("value")).alias("n"), fixed_sum("value").alias("total"))
    )
    return (
        minutes.groupBy(F.window(F.window_time("_minute"), "1 hour").alias("_hour"), *keys)
        .agg(F.sum("n").alias("n"), fixed_sum("total").alias("total"))
        .select(
            F.col("_hour.start").alias("window_start"), F.col("_hour.end").alias("window_end"), *keys, "n", "total"
        )
    )


def start_sensor_hours(
    readings: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = SENSOR_KEYS,
    delay: str = "1 hour",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each closed hour once (append mode, streaming file sink)."""
    return (
        hours_from_minutes(readings, keys, delay)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def hive_batch(batch: DataFrame, batch_id: int, sensors: DataFrame, table: str, precision: int = 60) -> None:
    """Sums of one micro-batch per hive, in the batch's own folder (a replay replaces it)."""
    rows = hive_summary(sensor_summary(batch, precision, sensors=sensors))
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(table)
    )


def start_hive_summary(
    readings: DataFrame,
    sensors: Callable[[SparkSession], DataFrame],
    table: str,
    checkpoint: str,
    precision: int = 60,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``sensors(spark)`` is called in every batch, so a rewritten dimension takes effect with the next one."""

    def run(batch: DataFrame, batch_id: int) -> None:
        hive_batch(batch, batch_id, sensors(batch.sparkSession), table, precision)

    return (
        readings.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def read_hive_summary(spark: SparkSession, table: str) -> DataFrame:
    """The sums of all batches, added per hive, level, type and period."""
    schema = T.StructType([*HIVE_SUMMARY.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(schema).parquet(table)
    return (
        rows.groupBy("hive", "bucket_ts", "precision", "level", "time", "sensor_type")
        .agg(fixed_sum("value_sum").alias("value_sum"), F.sum("value_count").alias("value_count"))
        .select(*HIVE_COLUMNS)
    )
