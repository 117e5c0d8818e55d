"""Streaming ingest: message stream → parsed readings → upserted day table.

Source: a Kafka topic (value as text, key ignored, starting offsets
``latest``) or, where no broker exists (tests), a folder of JSON-lines text
files. Each micro-batch goes through ``foreachBatch``:

1. parse and validate with the same functions as the batch path;
2. append the good readings to the table partitioned by ``bucket_date``
   and ``batch_id`` (merge-on-read: :func:`read_readings` keeps the newest
   row per (sensor_id, bucket_ts, time) by batch id and place in the source, and
   :func:`compact` merges batch folders into a table of their own);
3. write the quarantined messages and the batch's line counts, each into a
   ``batch_id`` partition with dynamic overwrite, so a replayed batch
   replaces its own output instead of adding to it.

The checkpoint location makes a restarted query resume after the last
committed batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apiary.operators.ingest import QUARANTINE_SCHEMA, parse_messages, quarantined, to_readings
from apiary.operators.upsert import append_batch, compact_batches, read_latest
from apiary.sources.messages import message_stream  # noqa: F401  (re-exported)
from apiary.schemas import READING_KEY, READING_PARTITION, SOURCE_POS

ORDER_COLUMNS = ("batch_id", "source_pos")

BATCH_COUNTS_ROW = T.StructType(
    [
        T.StructField("lines", T.LongType()),
        T.StructField("good", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
BATCH_COUNTS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("lines", T.LongType()),
        T.StructField("good", T.LongType()),
        T.StructField("quarantined", T.LongType()),
    ]
)


@dataclass
class IngestPaths:
    table: str
    quarantine: str
    counts: str
    checkpoint: str


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    paths: IngestPaths,
    on_counts: Callable[[int, int, int, int], None] | None = None,
    strict: bool = False,
) -> None:
    """Process one micro-batch (also usable on a plain batch DataFrame).

    The batch's line counts are gathered by an ``Observation`` on the parsed
    rows while the append job runs, so they cost no job of their own.
    ``on_counts(batch_id, lines, good, quarantined)`` receives them, e.g. to
    print them. With ``strict`` the first bad message fails the batch (and
    the query), and nothing of that batch is written.
    """
    spark = batch.sparkSession
    bid = F.lit(batch_id).cast("long")
    obs = Observation(f"ingest_{batch_id}_{uuid.uuid4().hex[:8]}")
    parsed = (
        parse_messages(batch, strict=strict, spread_narrow=False)
        .observe(
            obs,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("reason").isNull()).alias("good"),
            F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
        )
        .withColumn("batch_id", bid)
        .persist()
    )
    try:
        good = to_readings(parsed, strict=strict, keep=list(ORDER_COLUMNS))
        append_batch(good, paths.table, READING_PARTITION, "batch_id")
        (
            quarantined(parsed, ORDER_COLUMNS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(paths.quarantine)
        )
        m = obs.get
        counts = spark.createDataFrame(
            [(m["lines"], m["good"], m["quarantined"], batch_id)], BATCH_COUNTS_ROW
        )
        (
            counts.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(paths.counts)
        )
        if on_counts is not None:
            on_counts(batch_id, m["lines"], m["good"], m["quarantined"])
    finally:
        parsed.unpersist()


def print_counts(batch_id: int, lines: int, good: int, quarantined: int) -> None:
    print(f"batch {batch_id}: {lines} lines processed, {good} stored, {quarantined} quarantined")


def start_ingest(
    messages: DataFrame,
    paths: IngestPaths,
    trigger: dict | None = None,
    query_name: str | None = None,
    on_counts: Callable[[int, int, int, int], None] | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Start the ingest query; ``trigger`` defaults to 1-second micro-batches."""
    writer = (
        messages.writeStream.foreachBatch(
            lambda df, bid: ingest_batch(df, bid, paths, on_counts, strict)
        )
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
    )
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Line counts, one row per batch."""
    counts = read_latest(spark, path, BATCH_COUNTS_ROW, ["batch_id"], ["batch_id"])
    return counts.select(*BATCH_COUNTS.fieldNames())


def quarantine_schema() -> T.StructType:
    order = [T.StructField("source_pos", SOURCE_POS), T.StructField("batch_id", T.LongType())]
    return T.StructType([*QUARANTINE_SCHEMA.fields, *order])


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages that were not stored: key, raw text and reason."""
    rows = read_latest(spark, path, quarantine_schema(), ORDER_COLUMNS, ["batch_id"])
    return rows.select(*QUARANTINE_SCHEMA.fieldNames())


def compact_quarantine(spark: SparkSession, path: str, upto_batch: int | None = None) -> int:
    """Merge the batch folders of a quarantine (no row is dropped: batch and place in the source name a message)."""
    return compact_batches(
        spark, path, quarantine_schema(), ORDER_COLUMNS, ["batch_id"], [None], upto_batch, partition_col=None
    )


def compact_counts(spark: SparkSession, path: str, schema: T.StructType = BATCH_COUNTS_ROW, upto_batch: int | None = None) -> int:
    """Merge the batch folders of a table of line counts: one row per batch."""
    return compact_batches(spark, path, schema, ["batch_id"], ["batch_id"], [None], upto_batch, partition_col=None)


def read_readings(spark: SparkSession, table: str, where=None, columns: Sequence[str] | None = None) -> DataFrame:
    """The ingested readings, newest per key (merge-on-read); with ``columns`` only these, key and order are read."""
    # bucket_date follows from bucket_ts; as a key it lets a day filter on the
    # result reach the scan (partition pruning) instead of de-duplicating
    # every day first.
    return read_latest(
        spark, table, _stored_schema(), (*READING_KEY, READING_PARTITION), ORDER_COLUMNS, where, columns
    )


def _stored_schema() -> T.StructType:
    from apiary.sources.tables import STORED_READING

    return T.StructType(
        STORED_READING.fields
        + [T.StructField("batch_id", T.LongType()), T.StructField("source_pos", SOURCE_POS)]
    )


def compact(spark: SparkSession, table: str, days, upto_batch: int | None = None) -> int:
    """Merge the batch folders of ``days`` (see :func:`compact_batches`).

    While the stream runs, ``upto_batch`` must be a committed batch id.
    """
    return compact_batches(
        spark, table, _stored_schema(), READING_KEY, ORDER_COLUMNS, [str(d) for d in days], upto_batch, READING_PARTITION
    )


def compact_today(spark: SparkSession, table: str, day, upto_batch: int) -> int:
    """:func:`compact` of the one day a stream still writes."""
    return compact(spark, table, [day], upto_batch)
