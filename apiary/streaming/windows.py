"""Event-time windows on a stream, kept in a table keyed by window.

The windowed aggregate runs in ``update`` mode: each micro-batch emits the
windows it changed, with their totals so far. ``foreachBatch`` appends those
rows to the batch's own folder (merge-on-read); :func:`read_windows` keeps
the newest emission of every window, which is its current total, and equals
the batch aggregate once the input is consumed. A batch writes only what it
emitted, and a replayed batch overwrites its own folder. The watermark
bounds the state kept for open windows; rows later than the watermark are
dropped by Spark, so choose the delay from the lateness the feed can have.
Spark judges each batch's input against the watermark of the batch before
it, so a row is dropped one batch after the watermark passes its window
(see ``tests/test_streaming.py``).

The state store's partition count is taken from ``spark.sql.shuffle.partitions``
when the query first starts and is then fixed by its checkpoint: set it for
the stream (a few per core the stream uses) before the first start, not to
the thousands a batch session on a large cluster uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apiary.operators.upsert import (
    GENERATION,
    compact_batches,
    compacted_path,
    latest_per_key,
    read_all,
    table_exists,
)
from apiary.operators.windows import windowed, with_watermark


def _append_windows(table: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(table)
        )

    return write


def start_windowed(
    stream: DataFrame,
    time_col: str,
    duration: str,
    table: str,
    checkpoint: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    delay: str = "1 hour",
    trigger: dict | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Start the windowed aggregate.

    ``output_mode="update"`` writes live totals: a window is written again
    in every batch that changes it (compact with :func:`compact_windows`).
    ``"append"`` writes each window once, final, after the watermark has
    passed its end: no repeats, at the latency of the watermark delay (a
    finite input keeps its last windows open until more data moves the
    watermark).
    """
    if output_mode not in ("update", "append"):
        raise ValueError("output_mode must be 'update' or 'append'")
    agg = windowed(with_watermark(stream, time_col, delay), time_col, duration, slide, keys)
    return (
        agg.writeStream.outputMode(output_mode)
        .foreachBatch(_append_windows(table))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def _stored_schema(spark: SparkSession, table: str) -> T.StructType:
    """Columns of a window table; its keys are the caller's, so they are taken from the files."""
    merged = compacted_path(table)
    found = spark.read.parquet(merged if table_exists(spark, merged) else table)
    found = found.drop(GENERATION).withColumn("batch_id", F.col("batch_id").cast("long"))
    return found.schema


def read_windows(spark: SparkSession, table: str, keys: Sequence[str] = ()) -> DataFrame:
    """Current total of every window: its newest emission."""
    rows = read_all(spark, table, _stored_schema(spark, table))
    return latest_per_key(rows, ["window_start", "window_end", *keys], ["batch_id"]).drop("batch_id")


def compact_windows(spark: SparkSession, table: str, keys: Sequence[str], upto_batch: int | None = None) -> int:
    """Merge the batch folders up to a committed batch: one row per window."""
    return compact_batches(
        spark, table, _stored_schema(spark, table), ["window_start", "window_end", *keys], ["batch_id"],
        [None], upto_batch, partition_col=None,
    )
