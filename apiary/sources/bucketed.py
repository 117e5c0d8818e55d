"""Bucketed tables: co-located joins of two large sides without a shuffle.

When the sensor dimension is too large to broadcast, both it and the
readings can be stored bucketed by ``sensor_id`` into the same number of
buckets. A join of the two on ``sensor_id`` then reads bucket i of each side
in the same task: the plan has no exchange on either side, whatever their
size. The tables are catalog tables whose files live at a given path (an
external location in the shared folder); the bucket layout is recorded in
the catalog.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKET_KEY = "sensor_id"


def save_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    key: str = BUCKET_KEY,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write ``df`` as table ``table`` at ``path``, bucketed and sorted by ``key``.

    Use the same ``buckets`` for every table that is joined on ``key``;
    choose it so one bucket of the largest table fits a task (for example
    its size / 256 MB, per day partition when ``partition_by`` is the day).
    """
    writer = df.write.mode(mode).option("path", path).bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """The table through the catalog, so its bucket layout is used."""
    return spark.table(table)
