"""Measure the ingest stream at a fixed rate: 1-second micro-batches of made messages.

Usage: python tools/trigger_rate.py [--rate 1000] [--seconds 60] [--cores 4]

Prints, for the micro-batches after a warm-up, the rows taken and how long a
batch took: the stream keeps up while a batch stays below its trigger.
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from apiary.operators.ingest import encode_messages  # noqa: E402
from apiary.plans.testbed import uuid_of  # noqa: E402
from apiary.session import build_session  # noqa: E402
from apiary.streaming.ingest import IngestPaths, start_ingest  # noqa: E402
from apiary.streaming.progress import ProgressLog, read_progress  # noqa: E402

WARM_UP = 10


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--rate", type=int, default=1000)
    ap.add_argument("--seconds", type=int, default=60)
    ap.add_argument("--cores", type=int, default=4)
    args = ap.parse_args()
    spark = build_session(f"local[{args.cores}]", shuffle_partitions=args.cores, extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="trigger-rate-")
    n = F.col("value")
    rate = spark.readStream.format("rate").option("rowsPerSecond", args.rate).option("numPartitions", args.cores).load()
    records = rate.select(
        uuid_of(n % 3700).alias("serial_number"), F.col("timestamp").alias("sensor_snapshot"),
        (n % 37).cast("int").alias("floor"), (n % 25).cast("int").alias("hive_num"),
        *[(n % 100).cast("float").alias(c) for c in ("humidity", "latitude", "longitude", "temperature")],
        F.col("timestamp").alias("manuf_date"), F.lit(0).alias("movement"), F.lit(False).alias("retired"),
        F.lit("Temperature").alias("sensor_type"), F.lit("v").alias("vendor"), F.lit("w").alias("wing"),
    )
    with ProgressLog(spark) as log:
        q = start_ingest(encode_messages(records), IngestPaths(*(f"{root}/{p}" for p in ("table", "bad", "counts", "ck"))))
        time.sleep(args.seconds)
        q.stop()
        log.wait_for(str(q.runId))
        log.save(f"{root}/progress")
    batches = [r for r in read_progress(spark, f"{root}/progress").orderBy("batch_id").collect() if r.input_rows]
    ms = sorted(r.batch_ms for r in batches[WARM_UP:])
    rows = sum(r.input_rows for r in batches[WARM_UP:])
    print(
        f"{len(ms)} batches, {rows} rows; batch ms: median {statistics.median(ms):.0f}, "
        f"95 % below {ms[int(len(ms) * 0.95) - 1]}, longest {ms[-1]}"
    )
    spark.stop()


if __name__ == "__main__":
    main()
