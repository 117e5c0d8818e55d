"""Progress of running streams as a table: one row per micro-batch.

A :class:`ProgressLog` listens to all queries of a session. Each finished
micro-batch gives its times, input rows, state rows and the rows that came later
than the watermark; ``save`` appends what has been heard to a Parquet
folder. Spark counts late rows after its map-side combine: late rows of one task that
share a group count as one.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("batch_ts", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("batch_ms", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("watermark", T.StringType()),
    ]
)


def progress_row(progress) -> tuple:
    """One row of ``PROGRESS`` from a ``StreamingQueryProgress``."""
    operators = progress.stateOperators
    return (
        str(progress.id),
        str(progress.runId),
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.durationMs.get("triggerExecution", 0),
        sum(o.numRowsTotal for o in operators),
        sum(o.numRowsDroppedByWatermark for o in operators),
        progress.eventTime.get("watermark"),
    )


class ProgressLog(StreamingQueryListener):
    """Keeps the progress heard since the last ``save``; use it as a context manager."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(progress_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def wait_for(self, run_id: str, seconds: float = 30.0) -> None:
        """Events arrive after the query has ended: wait until its end was heard."""
        until = time.monotonic() + seconds
        while run_id not in self._ended:
            if time.monotonic() > until:
                raise TimeoutError(f"the end of run {run_id} was not heard in {seconds} s")
            time.sleep(0.05)

    def save(self, path: str) -> int:
        """Append the rows heard so far; returns their number."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(path)
        return len(rows)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: the last report, should a batch have been reported twice."""
    rows = spark.read.schema(PROGRESS).parquet(path)
    others = [f.name for f in PROGRESS.fields if f.name not in ("query_id", "batch_id")]
    latest = rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct(*others), "batch_ts").alias("r"))
    return latest.select("query_id", "batch_id", "r.*").select(*PROGRESS.fieldNames())
