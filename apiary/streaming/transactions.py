"""Streaming transaction ingest: flag, store, count lines, roll up per minute.

Each micro-batch (``foreachBatch``):

1. parses the JSON transactions and flags them (ACCEPTED / REJECTED),
   splitting the instant into the stored calendar fields;
2. appends them to the transactions table in (``date_text``, ``batch_id``)
   folders (merge-on-read by the key card, day, instant);
3. writes the bad messages with a reason, and the batch's line counts.

Every output of a batch lives in folders of that batch and is written with
dynamic overwrite, so a replayed batch replaces its output. The per-minute
rollup is taken from the newest row per key of the stored transactions, so a
transaction that is sent again counts once; it needs no streaming state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apiary.operators.ingest import quarantined
from apiary.operators.transactions import good_transactions, parse_transaction_messages, txn_count_min
from apiary.operators.upsert import append_batch, compact_batches, read_latest
from apiary.schemas import SOURCE_POS, TRANSACTION, TRANSACTION_KEY, TXN_COUNT_MIN
from apiary.streaming.ingest import read_quarantine

ORDER_COLUMNS = ("batch_id", "source_pos")
TXN_PARTITION = "date_text"

LINE_COUNTS = T.StructType(
    [
        T.StructField("lines", T.LongType()),
        T.StructField("transactions", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass
class TxnPaths:
    table: str
    counts: str
    checkpoint: str
    quarantine: str = ""
    # Folder of the kept per-minute counts; none are kept when empty.
    minutes: str = ""

    def __post_init__(self) -> None:
        self.quarantine = self.quarantine or f"{self.table}-quarantine"


def _overwrite_batch(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def txn_batch(
    batch: DataFrame,
    batch_id: int,
    paths: TxnPaths,
    on_counts: Callable[[int, int, int], None] | None = None,
    strict: bool = False,
) -> None:
    """Process one micro-batch; with ``strict`` the first bad message fails it and nothing is stored."""
    bid = F.lit(batch_id).cast("long")
    # Line and transaction counts are observed while the append job runs.
    seen = Observation(f"txns_{batch_id}_{uuid.uuid4().hex[:8]}")
    parsed = (
        parse_transaction_messages(batch, strict)
        .observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("good"))
        .withColumn("batch_id", bid)
        .persist()
    )
    try:
        good = good_transactions(parsed, ORDER_COLUMNS)
        append_batch(good, paths.table, TXN_PARTITION, "batch_id")
        if paths.minutes:
            refresh_minutes(good, batch_id, paths.table, paths.minutes)
        _overwrite_batch(quarantined(parsed, ORDER_COLUMNS), paths.quarantine)
        n_lines, n_txns = seen.get["lines"], seen.get["good"]
        counts = batch.sparkSession.createDataFrame([(n_lines, n_txns, batch_id)], LINE_COUNTS)
        _overwrite_batch(counts, paths.counts)
        if on_counts is not None:
            on_counts(batch_id, n_lines, n_txns)
    finally:
        parsed.unpersist()


def start_txn_ingest(
    messages: DataFrame,
    paths: TxnPaths,
    trigger: dict | None = None,
    on_counts: Callable[[int, int, int], None] | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Start the transaction stream; 1-second micro-batches by default."""
    return (
        messages.writeStream.foreachBatch(lambda df, bid: txn_batch(df, bid, paths, on_counts, strict))
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def _stored_schema() -> T.StructType:
    return T.StructType(
        [f for f in TRANSACTION.fields if f.name != TXN_PARTITION]
        + [
            T.StructField("source_pos", SOURCE_POS),
            T.StructField(TXN_PARTITION, T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )


def read_transactions(spark: SparkSession, table: str, columns=None) -> DataFrame:
    """Stored transactions, newest per key (merge-on-read)."""
    # date_text follows from the key's day; as a key it lets a day filter
    # reach the scan (partition pruning).
    return read_latest(
        spark, table, _stored_schema(), (*TRANSACTION_KEY, TXN_PARTITION), ORDER_COLUMNS, columns=columns
    )


def compact_transactions(spark: SparkSession, table: str, days, upto_batch: int | None = None) -> int:
    """Merge the batch folders of ``days`` (``date_text`` values; see :func:`compact_batches`)."""
    return compact_batches(
        spark, table, _stored_schema(), TRANSACTION_KEY, ORDER_COLUMNS, [str(d) for d in days], upto_batch, TXN_PARTITION
    )


def read_txn_count_min(spark: SparkSession, table: str, days=None) -> DataFrame:
    """Per-minute rollup with hour figures of the stored transactions.

    Each transaction counts once, however often it was sent. ``days``
    (``date_text`` values) limits the scan to these partitions.
    """
    txns = read_transactions(spark, table, columns=["txn_time", "status"])
    if days is not None:
        txns = txns.where(F.col(TXN_PARTITION).isin([str(d) for d in days]))
    return txn_count_min(txns)


def refresh_minutes(batch: DataFrame, batch_id: int, table: str, minutes: str) -> None:
    """Recompute the kept per-minute counts of the hours a batch touches.

    The hours are a short list (a live batch spans few; a batch of history at
    most 24 a day). Only their days are read (literal partition filter), and only
    their rows are counted. All minutes of a touched hour are written to the
    batch's own folders, one a day, and readers take the newest figures of a
    minute: minutes are never taken back, as a transaction's instant is in its
    key. The figures come from the newest row per key of the stored table, so
    late, repeated and corrected messages count once, and a replayed batch
    replaces its own folders.
    """
    spark = batch.sparkSession
    hour = F.date_trunc("hour", "txn_time")
    touched = batch.select(TXN_PARTITION, hour.alias("h")).distinct().collect()
    if not touched:
        return
    days = sorted({r[TXN_PARTITION] for r in touched})
    hours = [F.lit(r["h"]) for r in touched]
    of_hours = F.col(TXN_PARTITION).isin(days) & hour.isin(hours)
    txns = read_latest(
        spark, table, _stored_schema(), (*TRANSACTION_KEY, TXN_PARTITION), ORDER_COLUMNS, of_hours, ["status"]
    )
    counts = txn_count_min(txns).withColumn(TXN_PARTITION, F.format_string("%04d-%02d-%02d", "year", "month", "day"))
    rows = counts.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", TXN_PARTITION)
    append_batch(rows, minutes, TXN_PARTITION, "batch_id")


MINUTE_KEY = ("year", "month", "day", "hour", "minute")


def _minutes_schema() -> T.StructType:
    return T.StructType(
        [*TXN_COUNT_MIN.fields, T.StructField(TXN_PARTITION, T.StringType()), T.StructField("batch_id", T.LongType())]
    )


def read_minutes(spark: SparkSession, minutes: str, days=None) -> DataFrame:
    """The kept per-minute counts; ``days`` (``date_text`` values) limits the scan to these partitions."""
    of_days = None if days is None else F.col(TXN_PARTITION).isin([str(d) for d in days])
    kept = read_latest(spark, minutes, _minutes_schema(), (*MINUTE_KEY, TXN_PARTITION), ["batch_id"], of_days)
    return kept.select(*TXN_COUNT_MIN.fieldNames())


def compact_minutes(spark: SparkSession, minutes: str, days, upto_batch: int | None = None) -> int:
    """Merge the kept counts' batch folders of ``days``: one row per minute (see :func:`compact_batches`)."""
    return compact_batches(
        spark, minutes, _minutes_schema(), MINUTE_KEY, ["batch_id"], [str(d) for d in days], upto_batch, TXN_PARTITION
    )


def read_txn_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """Messages that were not stored: key, raw text and reason."""
    return read_quarantine(spark, quarantine)


def read_line_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Line counts, one row per batch."""
    return read_latest(spark, counts, LINE_COUNTS, ["batch_id"], ["batch_id"])
