"""Streaming de-duplication with state: the first copy of a reading is kept.

``dropDuplicatesWithinWatermark`` remembers every key until the watermark is
``delay`` past its event time, so a copy that arrives within the delay is
dropped, across micro-batches and restarts. The remembered keys live in a RocksDB
state store: they may outgrow an executor's heap, and a checkpoint holds only
what changed. The output is a streaming file sink, whose commit log makes it
exactly once.

Unlike the merge-on-read table (:mod:`apiary.streaming.ingest`), which keeps
the newest copy and needs no state, a kept row is final here, and readers need no
aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from apiary.operators.ingest import parse_messages, to_readings
from apiary.operators.windows import with_watermark
from apiary.schemas import READING_KEY, READING_PARTITION
from apiary.sources.tables import STORED_READING

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Settings a query takes along when it starts; the session's own are put back."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def first_per_key(rows: DataFrame, keys: Sequence[str], time_col: str = "time", delay: str = "1 hour") -> DataFrame:
    """The first copy of each key that arrives; copies may lie up to ``delay`` apart in event time."""
    return with_watermark(rows, time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def start_dedup(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    delay: str = "1 hour",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages → readings, one per (sensor, day, instant), in a day-partitioned folder."""
    good = to_readings(parse_messages(messages, spread_narrow=False))
    with rocksdb_state(messages.sparkSession):
        return (
            first_per_key(good, READING_KEY, "time", delay)
            .select(*STORED_READING.fieldNames())
            .writeStream.format("parquet")
            .option("path", table)
            .option("checkpointLocation", checkpoint)
            .partitionBy(READING_PARTITION)
            .outputMode("append")
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )


def read_dedup(spark: SparkSession, table: str) -> DataFrame:
    """The kept readings; files that no commit names are not read."""
    return spark.read.schema(STORED_READING).parquet(table)
