"""Command-line jobs: the streaming consumers and the batch reports.

    python -m apiary.cli ingest --kind kafka --servers HOST:9092 --topic sensors --root DIR [--strict] [--progress]
    python -m apiary.cli txn-ingest --kind kafka --servers HOST:9092 --topic txns --root DIR [--minutes]
    python -m apiary.cli hive-average --readings DIR --sensors DIR [--as-of 2017-01-29] [--days-back 7]
        [--hive H …] [--level L …] [--wing W …] [--since 2017-01-29T06:00 --until 2017-01-29T18:00]
    python -m apiary.cli compact --table DIR [--day 2017-01-29 --upto-batch N]
    python -m apiary.cli expire --table DIR --as-of 2017-04-15 [--days 90]
    python -m apiary.cli summaries --readings DIR --sensors DIR --out DIR --as-of 2017-01-29 [--days-back 0]

``--root`` is a shared folder holding the job's tables and checkpoint; a
restarted ingest resumes from its checkpoint. Settings come from flags with
defaults, not from a config file.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import functions as F

from apiary.session import build_session, work_root


# How often a running job saves its progress.
SAVE_SECONDS = 60


def _ingest_paths(root: str):
    from apiary.streaming.ingest import IngestPaths

    return IngestPaths(
        table=os.path.join(root, "sensor_data"),
        quarantine=os.path.join(root, "quarantine"),
        counts=os.path.join(root, "batch_counts"),
        checkpoint=os.path.join(root, "_checkpoint"),
    )


def _txn_paths(root: str, minutes: bool = False):
    from apiary.streaming.transactions import TxnPaths

    return TxnPaths(
        table=os.path.join(root, "transactions"),
        counts=os.path.join(root, "txn_lines"),
        checkpoint=os.path.join(root, "_checkpoint"),
        minutes=os.path.join(root, "txn_count_min") if minutes else "",
    )


def _stream(spark, args):
    from apiary.sources.messages import message_stream

    return message_stream(
        spark,
        args.kind,
        path=args.path,
        topic=args.topic,
        bootstrap_servers=args.servers,
        starting_offsets=args.starting_offsets,
        max_files_per_trigger=args.max_files,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
    )


def _trigger(args) -> dict:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": f"{args.trigger_seconds} seconds"}


@contextmanager
def _progress(spark, args):
    """Keeps the progress of the stream below the root, when asked for."""
    if not args.progress:
        yield
        return
    from apiary.streaming.progress import ProgressLog

    with ProgressLog(spark) as log:
        args.log = log
        try:
            yield
        finally:
            log.save(os.path.join(args.root, "progress"))


def _await(q, args) -> None:
    """Wait for the end of the query; its progress, if kept, is saved once a minute."""
    left = args.timeout
    while left is None or left > 0:
        step = SAVE_SECONDS if left is None else min(SAVE_SECONDS, left)
        if q.awaitTermination(step):
            break
        left = None if left is None else left - step
        if args.progress:
            args.log.save(os.path.join(args.root, "progress"))
    if args.progress and not q.isActive:
        args.log.wait_for(str(q.runId))


def cmd_ingest(spark, args) -> None:
    from apiary.streaming.ingest import print_counts, start_ingest

    paths = _ingest_paths(args.root)
    with _progress(spark, args):
        q = start_ingest(_stream(spark, args), paths, _trigger(args), on_counts=print_counts, strict=args.strict)
        _await(q, args)


def cmd_txn_ingest(spark, args) -> None:
    from apiary.streaming.transactions import start_txn_ingest

    def show(batch_id: int, lines: int, txns: int) -> None:
        print(f"batch {batch_id}: {lines} lines processed, {txns} transactions stored")

    paths = _txn_paths(args.root, args.minutes)
    with _progress(spark, args):
        q = start_txn_ingest(_stream(spark, args), paths, _trigger(args), on_counts=show, strict=args.strict)
        _await(q, args)


def cmd_hive_average(spark, args) -> None:
    from apiary.operators.aggregate import hive_average, report_lines
    from apiary.operators.joins import sensor_day_join
    from apiary.sources.tables import read_sensors
    from apiary.streaming.ingest import read_readings

    # Key, order and value are all the averages need.
    readings = read_readings(spark, args.readings, columns=["sensor_type", "value"])
    for flag, test in (("since", "time >= '{}'"), ("until", "time < '{}'")):
        instant = getattr(args, flag)
        if instant is not None:
            readings = readings.where(test.format(dt.datetime.fromisoformat(instant)))
    sensors = read_sensors(spark, args.sensors)
    for name in ("hive", "level", "wing"):
        wanted = getattr(args, name)
        if wanted is not None:
            sensors = sensors.where(F.col(name).isin(wanted))
    averages = hive_average(sensor_day_join(readings, sensors, as_of=args.as_of, days_back=args.days_back))
    if args.output:
        averages.write.mode("overwrite").parquet(args.output)
    else:
        # one line per hive: a short result, printed on the driver
        for row in report_lines(averages.orderBy("hive")).toLocalIterator():
            print(row.line)


def cmd_compact(spark, args) -> None:
    from apiary.operators.upsert import last_committed, list_partitions
    from apiary.streaming import ingest, transactions

    kind = os.path.basename(args.table.rstrip("/"))
    if kind in ("quarantine", "transactions-quarantine", "batch_counts", "txn_lines"):
        checkpoint = args.checkpoint or os.path.join(os.path.dirname(args.table.rstrip("/")), "_checkpoint")
        upto = last_committed(spark, checkpoint) if args.upto_batch is None else args.upto_batch
        if kind.endswith("quarantine"):
            merged = ingest.compact_quarantine(spark, args.table, upto)
        else:
            schema = transactions.LINE_COUNTS if kind == "txn_lines" else ingest.BATCH_COUNTS_ROW
            merged = ingest.compact_counts(spark, args.table, schema, upto)
        print(f"compacted {merged} batch folders")
        return
    day_col, compact = {
        "transactions": (transactions.TXN_PARTITION, transactions.compact_transactions),
        "txn_count_min": (transactions.TXN_PARTITION, transactions.compact_minutes),
    }.get(kind, (ingest.READING_PARTITION, ingest.compact))
    checkpoint = args.checkpoint or os.path.join(os.path.dirname(args.table.rstrip("/")), "_checkpoint")
    upto = last_committed(spark, checkpoint) if args.upto_batch is None else args.upto_batch
    days = [args.day] if args.day is not None else list_partitions(spark, args.table, day_col)
    print(f"compacted {compact(spark, args.table, days, upto)} batch folders of {len(days)} days")


def cmd_expire(spark, args) -> None:
    from apiary.operators.retention import expire

    dropped = expire(spark, args.table, dt.date.fromisoformat(args.as_of), args.days)
    print(f"dropped {len(dropped)} day partitions")


def cmd_summaries(spark, args) -> None:
    """Minute and hour summaries per sensor and per hive for a day range."""
    import time

    from apiary.operators.joins import in_days
    from apiary.operators.summaries import hive_summary, rollup_sensor_summary, sensor_summary
    from apiary.sources.tables import read_sensors, save_hive_summary, save_sensor_summary
    from apiary.streaming.ingest import read_readings

    run_id = int(time.time())
    readings = in_days(read_readings(spark, args.readings), args.as_of, args.days_back)
    minute = sensor_summary(readings, 60, sensors=read_sensors(spark, args.sensors))
    work_root(spark)  # the RDD checkpoint folder: the cluster's, or a local one when unset
    minute = minute.checkpoint()  # cut lineage: both tables below read it
    hour = rollup_sensor_summary(minute, 3600)
    for precision, summary in ((60, minute), (3600, hour)):
        save_sensor_summary(summary, os.path.join(args.out, "sensor_data_summary"), run_id)
        save_hive_summary(hive_summary(summary), os.path.join(args.out, "hive_summary"), run_id)
        print(f"precision {precision}: saved")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="apiary")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "txn-ingest"):
        p = sub.add_parser(name)
        p.add_argument("--kind", choices=["kafka", "text"], default="kafka")
        p.add_argument("--servers")
        p.add_argument("--topic")
        p.add_argument("--path", help="folder of JSON-lines files (kind=text)")
        p.add_argument("--root", required=True)
        p.add_argument("--starting-offsets", default="latest")
        p.add_argument("--max-files", type=int)
        p.add_argument("--max-offsets", type=int)
        p.add_argument("--min-partitions", type=int)
        p.add_argument("--trigger-seconds", type=int, default=1)
        p.add_argument("--available-now", action="store_true")
        p.add_argument("--timeout", type=int, help="seconds to wait; default: until stopped")
        p.add_argument("--strict", action="store_true", help="the first bad message ends the job")
        p.add_argument("--progress", action="store_true", help="keep one row per micro-batch in ROOT/progress")
        if name == "txn-ingest":
            p.add_argument("--minutes", action="store_true", help="keep per-minute counts in ROOT/txn_count_min")
    p = sub.add_parser("hive-average")
    p.add_argument("--readings", required=True)
    p.add_argument("--sensors", required=True)
    p.add_argument("--as-of")
    p.add_argument("--days-back", type=int, default=7)
    p.add_argument("--hive", type=int, nargs="+", help="sensors of these hives only")
    p.add_argument("--level", type=int, nargs="+", help="sensors of these levels only")
    p.add_argument("--wing", nargs="+", help="sensors of these wings only")
    p.add_argument("--since", help="readings from this instant on (ISO, UTC)")
    p.add_argument("--until", help="readings before this instant (ISO, UTC)")
    p.add_argument("--output")
    p = sub.add_parser("compact")
    p.add_argument("--table", required=True)
    p.add_argument("--day")
    p.add_argument("--upto-batch", type=int, help="a committed batch; default: the checkpoint's last")
    p.add_argument("--checkpoint", help="the stream's checkpoint; default: _checkpoint beside the table")
    p = sub.add_parser("summaries")
    p.add_argument("--readings", required=True)
    p.add_argument("--sensors", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of")
    p.add_argument("--days-back", type=int, default=0)
    p = sub.add_parser("expire")
    p.add_argument("--table", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--days", type=int, default=90)
    return ap


COMMANDS = {
    "ingest": cmd_ingest,
    "txn-ingest": cmd_txn_ingest,
    "hive-average": cmd_hive_average,
    "compact": cmd_compact,
    "expire": cmd_expire,
    "summaries": cmd_summaries,
}


def main(argv: Sequence[str] | None = None, spark=None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(app_name=f"apiary-{args.cmd}")
    COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main()
