"""Queries over stored, streamed and bucketed tables, each with a DuckDB oracle.

They run whole flows (stream → stored table → report) over the test tables and
return what was stored; see :mod:`apiary.plans.catalog` for the conventions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apiary.functions.baskets import ITEM_PREFIX
from apiary.operators import aggregate, ingest, joins, lookup, summaries, topology, upsert
from apiary.operators.windows import windowed, with_watermark
from apiary.plans import catalog
from apiary.plans import testbed as tb
from apiary.plans.catalog import (
    FILTER_WING,
    FIRST_DAY,
    LAST_DAY,
    SQL_GOOD,
    SQL_READINGS,
    SQL_REC,
    SQL_SENSORS,
    STORED_COLUMNS,
    query,
    sql_with,
)
from apiary.schemas import READING_KEY, READING_PARTITION
from apiary.session import work_path
from apiary.sources import bucketed, messages, tables
from apiary.streaming import dedup
from apiary.streaming import ingest as stream_ingest
from apiary.streaming import progress as stream_progress_
from apiary.streaming import summaries as stream_summaries
from apiary.streaming import transactions as stream_txn

ALL_AT_ONCE = {"availableNow": True}
# Event time from the first to the last row of the test feeds is below this.
FEED_SPAN = "60 days"


def finished(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


# --------------------------------------------------------------------------
# Stored tables


@query(
    "hive_average_stored",
    sql_with(SQL_REC, SQL_GOOD, SQL_SENSORS)
    + catalog._hive_sql(
        f"""(SELECT s.hive, g.value FROM good g JOIN sensors s ON g.sensor_id = s.sensor_id
             WHERE s.wing = '{FILTER_WING}' AND g.bucket_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}')""",
        True,
    ),
)
def hive_average_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of one wing from the streamed table, days pruned by the stored (sensor, day) rows."""
    paths = catalog._run_ingest_stream(spark, sf_dir)
    # Some days are merged, the others read from their batches: both scans are pruned.
    days = upsert.list_partitions(spark, paths.table)
    stream_ingest.compact(spark, paths.table, days[: len(days) // 2])
    daily = work_path(spark, "tables", "daily_topology")
    tables.save_daily_topology(topology.daily_topology(tb.sensors(spark, sf_dir), as_of=tb.AS_OF), daily)
    return stored_average(spark, paths.table, daily)


def stored_average(spark: SparkSession, table: str, daily: str) -> DataFrame:
    readings = stream_ingest.read_readings(spark, table, columns=["value"])
    of_wing = tables.read_daily_topology(spark, daily).where(F.col("wing") == FILTER_WING)
    return aggregate.hive_average(joins.join_stored_topology(readings, of_wing.drop("bucket_ts")))


@query(
    "readings_by_source_order",
    sql_with(SQL_REC)
    + f"""
SELECT sensor_id, date_trunc('day', t) AS bucket_ts, t AS time, hive, level, wing, sensor_type,
       CASE WHEN k % 3 <> 0 AND k % 2 = 0 THEN corrected ELSE value END AS value, latlong, CAST(t AS DATE) AS bucket_date
FROM (SELECT rec.*, date_trunc('millisecond', rec.ts) AS t,
             CASE rec.event_type WHEN 'click' THEN CAST(e.value + 1 AS FLOAT) WHEN 'view' THEN CAST((e.value + 1) * 2 AS FLOAT)
                  WHEN 'purchase' THEN CAST(floor(e.value + 1) AS FLOAT) END AS corrected
      FROM rec JOIN events e ON e.event_id = rec.event_id)
WHERE event_type IN ({", ".join(f"'{t}'" for t in tb.EVENT_SENSOR_TYPES)})""",
)
def readings_by_source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages sent again: the copy that stands last in the source wins."""
    return tb.to_ntz(newest_by_source(spark, source_order_feed(spark, sf_dir)).select(*STORED_COLUMNS))


def source_order_feed(spark: SparkSession, sf_dir: str) -> str:
    """Text files: a correction follows its message in the same file (k even); a later file repeats
    the first form (k a multiple of 3)."""
    records = tb.sensor_records(spark, sf_dir)
    value = tb.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), F.col("value").alias("_value"))
    first = ingest.encode_messages(records, keep=("key", "k"))
    again = ingest.encode_messages(
        records.join(value, "key").select(
            *[
                {
                    "temperature": (F.col("_value") + 1).cast("float").alias("temperature"),
                    "humidity": ((F.col("_value") + 1) * 2).cast("float").alias("humidity"),
                    "movement": F.floor(F.col("_value") + 1).cast("int").alias("movement"),
                }.get(c, F.col(c))
                for c in records.columns
            ]
        ),
        keep=("key",),
    ).withColumnRenamed("value", "_again")
    both = first.join(again, "key")
    feed = work_path(spark, "feeds", "source-order")
    lines = F.when(F.col("k") % 2 == 0, F.array("value", "_again")).otherwise(F.array("value"))
    both.select(F.explode(lines).alias("value")).write.text(feed)
    both.where("k % 3 = 0").select("value").write.mode("append").text(feed)
    return feed


def newest_by_source(spark: SparkSession, feed: str) -> DataFrame:
    parsed = ingest.parse_messages(messages.read_messages(spark, feed))
    readings = ingest.to_readings(parsed, keep=["source_pos"])
    return upsert.latest_per_key(readings, [*READING_KEY, READING_PARTITION], ["source_pos"])


@query(
    "bucketed_sensor_join",
    sql_with(SQL_READINGS, SQL_SENSORS)
    + "SELECT r.sensor_id, r.time, r.sensor_type, r.value, s.hive, s.level, s.wing "
    "FROM readings r JOIN sensors s ON r.sensor_id = s.sensor_id",
)
def bucketed_sensor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and sensors stored in buckets of the sensor, joined bucket by bucket."""
    return tb.to_ntz(bucket_join(*bucketed_tables(spark, sf_dir)))


def bucketed_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = []
    for df in (tb.readings(spark, sf_dir).drop("event_id"), tb.sensors(spark, sf_dir).drop("sensor_type")):
        name = f"bucketed_{uuid.uuid4().hex}"
        bucketed.save_bucketed(df, name, work_path(spark, "bucketed"), buckets)
        out.append(bucketed.read_bucketed(spark, name))
    return out[0], out[1]


def bucket_join(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    # Two large sides: neither is to be broadcast, whatever its size here.
    joined = readings.hint("merge").join(sensors, "sensor_id")
    return joined.select("sensor_id", "time", "sensor_type", "value", "hive", "level", "wing")


# --------------------------------------------------------------------------
# Streams with state


@query("stream_dedup_readings", sql_with(SQL_REC, SQL_GOOD) + f"SELECT {', '.join(STORED_COLUMNS)} FROM good")
def stream_dedup_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages sent twice, half of them after a restart: one row per key."""
    feed = work_path(spark, "feeds", "twice")
    table, checkpoint = work_path(spark, "tables", "dedup"), work_path(spark, "checkpoints")
    msgs = tb.sensor_messages(spark, sf_dir).select("value")
    for part in (msgs, msgs.where(F.pmod(F.xxhash64("value"), F.lit(2)) == 0)):
        part.write.mode("append").text(feed)
        stream = messages.message_stream(spark, "text", feed, max_files_per_trigger=catalog._files_per_trigger(spark))
        finished(dedup.start_dedup(stream, table, checkpoint, delay=FEED_SPAN, trigger=ALL_AT_ONCE))
    return tb.to_ntz(dedup.read_dedup(spark, table).select(*STORED_COLUMNS))


FEED_SCHEMA = "sensor_id string, time timestamp, sensor_type string, value float"


def readings_feed(spark: SparkSession, feed: str, *files: DataFrame) -> DataFrame:
    """Stream of a folder of readings, several files a batch, after ``files`` were added to it one by one."""
    for df in files:
        df.select("sensor_id", "time", "sensor_type", "value").write.mode("append").parquet(feed)
    return spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", catalog._files_per_trigger(spark)).parquet(feed)


END_OF_FEED = "end of feed"


def end_of_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row far past the last reading: it moves the watermark, so that the last windows close."""
    last = tb.readings(spark, sf_dir).agg(F.max("time").alias("time"))
    return last.select(
        F.lit(END_OF_FEED).alias("sensor_id"), (F.col("time") + F.expr("INTERVAL 200 DAYS")).alias("time"),
        F.lit(None).cast("string").alias("sensor_type"), F.lit(None).cast("float").alias("value"),
    )


@query("stream_sensor_summary_hour", sql_with(SQL_READINGS, SQL_SENSORS) + catalog._summary_sql(3600))
def stream_sensor_summary_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour summary kept by one stream: minute windows summed into hour windows."""
    table = work_path(spark, "tables", "hours")
    feed = work_path(spark, "feeds", "readings")
    stream = readings_feed(spark, feed, tb.readings(spark, sf_dir), end_of_feed(spark, sf_dir))
    finished(
        stream_summaries.start_sensor_hours(
            stream, table, work_path(spark, "checkpoints"), delay=FEED_SPAN, trigger=ALL_AT_ONCE
        )
    )
    hours = spark.read.parquet(table).where(F.col("sensor_id") != END_OF_FEED)
    return tb.to_ntz(summaries.summary_from_windows(hours, 3600, sensors=tb.sensors(spark, sf_dir)))


@query("stream_hive_summary", catalog.ORACLE["hive_summary"])
def stream_hive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hive summary kept by a stream that joins the stored sensor dimension in every batch."""
    dimension, table = work_path(spark, "tables", "sensors"), work_path(spark, "tables", "hive_summary")
    tb.sensors(spark, sf_dir).write.parquet(dimension)
    finished(
        stream_summaries.start_hive_summary(
            readings_feed(spark, work_path(spark, "feeds", "readings"), tb.readings(spark, sf_dir)), lambda s: tables.read_sensors(s, dimension), table,
            work_path(spark, "checkpoints"), trigger=ALL_AT_ONCE,
        )
    )
    return tb.to_ntz(stream_summaries.read_hive_summary(spark, table))


@query(
    "stream_progress",
    """
SELECT CAST(count(*) + count_if(late) + 1 AS BIGINT) AS input_rows, count(*) AS counted_rows,
       CAST(count_if(late) AS BIGINT) AS late_rows
FROM (SELECT event_id % 10 = 0 AS late FROM events)""",
)
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with rows that come far too late: what went in was counted or reported late."""
    readings = tb.readings(spark, sf_dir)
    late = readings.where(F.col("event_id") % 10 == 0).withColumn("time", F.col("time") - F.expr("INTERVAL 100 DAYS"))
    log_path, table = work_path(spark, "tables", "progress"), work_path(spark, "tables", "seconds")
    checkpoint, feed = work_path(spark, "checkpoints"), work_path(spark, "feeds", "readings")
    with stream_progress_.ProgressLog(spark) as log:
        for files in ((readings, end_of_feed(spark, sf_dir)), (late,)):
            stream = readings_feed(spark, feed, *files)
            # One event is one group, so the late rows are counted one by one.
            seconds = windowed(
                with_watermark(stream, "time", FEED_SPAN), "time", "1 second", keys=["sensor_id", "sensor_type"]
            )
            q = finished(
                seconds.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(**ALL_AT_ONCE).start()
            )
            log.wait_for(str(q.runId))
        log.save(log_path)
    heard = stream_progress_.read_progress(spark, log_path).agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows")
    )
    counted = spark.read.parquet(table).agg(F.sum("n").alias("counted_rows"))
    return heard.crossJoin(counted).select("input_rows", "counted_rows", "late_rows")


@query("txn_count_min_stored", catalog.ORACLE["txn_count_min"])
def txn_count_min_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-minute counts kept as a table: each batch recomputes the hours it touched."""
    paths = catalog._run_txn_stream(spark, sf_dir, keep_minutes=True)
    return stream_txn.read_minutes(spark, paths.minutes)


@query(
    "stream_encode_readings",
    sql_with(SQL_REC)
    + """
SELECT sensor_id, date_trunc('day', ts) AS bucket_ts, date_trunc('millisecond', ts) AS time,
       hive, level, wing, sensor_type, value, latlong
FROM rec""",
)
def stream_encode_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings published as JSON text by a stream, read back and decoded."""
    feed, out = work_path(spark, "feeds", "stored"), work_path(spark, "feeds", "encoded")
    projected = ingest.to_readings(tb.sensor_records(spark, sf_dir))
    projected.write.parquet(feed)
    stream = (
        spark.readStream.schema(projected.schema)
        .option("maxFilesPerTrigger", catalog._files_per_trigger(spark))
        .parquet(feed)
    )
    encoded = ingest.encode_readings(stream)
    finished(messages.start_write_messages(encoded, out, work_path(spark, "checkpoints"), ALL_AT_ONCE))
    return tb.to_ntz(ingest.decode_readings(messages.read_messages(spark, out)))


# --------------------------------------------------------------------------
# Range lookup with bounds of any number


@query(
    "range_lookup_large",
    f"""
WITH price AS (
  SELECT l_extendedprice AS hi, min('{ITEM_PREFIX}' || CAST(l_partkey AS VARCHAR)) AS name FROM lineitem GROUP BY 1),
u AS (SELECT o_orderkey, o_totalprice / 4 AS u FROM orders)
SELECT o_orderkey, u, coalesce(price.name, '{lookup.DEFAULT_NAME}') AS name
FROM u ASOF LEFT JOIN price ON u.u <= price.hi""",
)
def range_lookup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of each order's price looked up among the prices of all line items."""
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 4).alias("u"))
    price = tb.table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("hi"), F.concat(F.lit(ITEM_PREFIX), F.col("l_partkey").cast("string")).alias("name")
    )
    return lookup.range_lookup_sorted(orders, "u", price)
