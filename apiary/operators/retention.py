"""Retention: raw readings are kept 90 days, summaries 365 days.

``retained`` is the read-side filter (on the partition column, so expired
days are never listed, and on the instant for the exact cut). ``expire``
drops whole expired day partitions of a stored table: a listing of the day
folders (one per day, so a short list) and a delete per expired folder,
through the Hadoop file system API the table lives on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apiary.operators.topology import as_of_date
from apiary.operators.upsert import compacted_path, list_partitions

# Retention periods in days of the stored tables (fixed values).
RAW_DAYS = 90
SUMMARY_DAYS = 365


def cutoff(as_of, days: int) -> F.Column:
    """First instant kept: midnight of ``as_of`` minus ``days``."""
    return F.date_sub(as_of_date(as_of), days).cast("timestamp")


def retained(
    df: DataFrame, as_of=None, days: int = RAW_DAYS, time_col: str = "time",
    partition_col: str | None = "bucket_date",
) -> DataFrame:
    first = cutoff(as_of, days)
    out = df
    if partition_col and partition_col in df.columns:
        out = out.where(F.col(partition_col) >= F.date_sub(as_of_date(as_of), days))
    return out.where(F.col(time_col) >= first)


def expire(
    spark: SparkSession, table_path: str, as_of: dt.date, days: int = RAW_DAYS,
    partition_col: str = "bucket_date",
) -> list[str]:
    """Delete day partitions older than the cut, merged rows as well; returns the deleted days."""
    first = as_of - dt.timedelta(days=days)
    dropped = set()
    for path in (table_path, compacted_path(table_path)):
        for name in list_partitions(spark, path, partition_col):
            try:
                day = dt.date.fromisoformat(name)
            except ValueError:  # e.g. the folder of null partition values
                continue
            if day < first:
                folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{partition_col}={name}")
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
                dropped.add(name)
    return sorted(dropped)
