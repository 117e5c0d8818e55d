"""Named queries over the generated test tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` builds a Spark DataFrame from the whole
tables; ``ORACLE[name]`` is SQL over the same parquet tables (registered as
views ``events``, ``customer`` …) that states the same result. Column names
and types agree between the two (instants as TIMESTAMP_NTZ, counts BIGINT).
Queries that run a stream or write tables do so inside their function and
return a DataFrame over what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apiary.functions import readings as readings_fn
from apiary.functions.baskets import item_entries
from apiary.functions.buckets import bucket, bucket_epoch
from apiary.functions.readings import UUID_PATTERN, latlong, pick_value
from apiary.operators import (
    aggregate,
    ingest,
    joins,
    lookup,
    retention,
    summaries,
    topology,
    upsert,
    windows,
)
from apiary.operators import transactions as txn_ops
from apiary.operators.strategy import join_small, spread
from apiary.plans import testbed as tb
from apiary.schemas import READING_KEY
from apiary.session import work_path
from apiary.streaming import ingest as stream_ingest
from apiary.streaming import transactions as stream_txn
from apiary.streaming import windows as stream_windows

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


# --------------------------------------------------------------------------
# SQL building blocks of the oracle (DuckDB dialect)


def sql_uuid(expr: str) -> str:
    h = f"md5(CAST({expr} AS VARCHAR))"
    return (
        f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'"
        f"||substr({h},17,4)||'-'||substr({h},21,12))"
    )


def sql_fixed_sum(expr: str) -> str:
    """Exact sum: whole units of 2**-32 as integers, and what is left of each value below one unit."""
    x = f"(CAST({expr} AS DOUBLE) * 4294967296.0)"
    return f"((CAST(sum(CAST(floor{x} AS HUGEINT)) AS DOUBLE) + sum({x} - floor{x})) / 4294967296.0)"


SQL_READINGS = f"""
readings AS (
  SELECT event_id, {sql_uuid('user_id')} AS sensor_id, date_trunc('day', ts) AS bucket_ts,
         ts AS time, event_type AS sensor_type, CAST(value AS FLOAT) AS value,
         CAST(ts AS DATE) AS bucket_date
  FROM events)"""

SQL_SENSORS = f"""
sensors AS (
  SELECT {sql_uuid('c_custkey')} AS sensor_id, c_nationkey AS hive,
         CAST(floor(c_acctbal / 1000) AS INTEGER) AS level, c_mktsegment AS wing,
         CAST(CAST(c_acctbal / 100 AS FLOAT) AS VARCHAR) || ', '
           || CAST(CAST(c_custkey / 1000 AS FLOAT) AS VARCHAR) AS latlong,
         'Any' AS sensor_type
  FROM customer)"""

FIRST_DAY, LAST_DAY = "2024-01-23", tb.AS_OF


def sql_with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SQL_JOINED = f"""
joined AS (
  SELECT r.sensor_id, r.bucket_date, r.bucket_ts, r.time, r.sensor_type, r.value,
         s.hive, s.level, s.wing, s.latlong
  FROM readings r JOIN sensors s ON r.sensor_id = s.sensor_id
  WHERE r.bucket_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}')"""


def _hive_sql(source: str, average: bool) -> str:
    avg = f", {sql_fixed_sum('value')} / count(value) AS average" if average else ""
    return (
        f"SELECT hive, count(value) AS n, {sql_fixed_sum('value')} AS total{avg} "
        f"FROM {source} GROUP BY hive"
    )


# --------------------------------------------------------------------------
# Sensor dimension, (sensor, day) join, per-hive aggregates


def _joined(spark: SparkSession, sf_dir: str, sensors=None, readings=None) -> DataFrame:
    sensors = tb.sensors(spark, sf_dir) if sensors is None else sensors
    readings = tb.readings(spark, sf_dir) if readings is None else readings
    return joins.sensor_day_join(readings, sensors, as_of=tb.AS_OF)


@query("hive_count_sum", sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED) + _hive_sql("joined", False))
def hive_count_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.hive_count_sum(_joined(spark, sf_dir))


@query("hive_average", sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED) + _hive_sql("joined", True))
def hive_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.hive_average(_joined(spark, sf_dir))


@query(
    "hive_report",
    sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED)
    + "SELECT 'Average for hive ' || hive || ' = ' || CAST(average AS VARCHAR) AS line FROM ("
    + _hive_sql("joined", True)
    + ")",
)
def hive_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One printable line per hive."""
    return aggregate.report_lines(hive_average(spark, sf_dir))


@query(
    "sensor_day_join",
    sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED) + "SELECT * FROM joined",
)
def sensor_day_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(_joined(spark, sf_dir))


@query(
    "sensor_day_join_keyed",
    sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED) + "SELECT * FROM joined",
)
def sensor_day_join_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join through the explicit (sensor, day) driving set."""
    daily = topology.daily_topology(tb.sensors(spark, sf_dir), as_of=tb.AS_OF)
    out = joins.join_daily_topology(tb.readings(spark, sf_dir), daily)
    return tb.to_ntz(
        out.select(
            "sensor_id", "bucket_date", "bucket_ts", "time", "sensor_type", "value",
            "hive", "level", "wing", "latlong",
        )
    )


@query(
    "daily_topology",
    sql_with(SQL_SENSORS)
    + f"""
SELECT CAST(d AS DATE) AS bucket_date, CAST(d AS TIMESTAMP) AS bucket_ts,
       sensor_id, hive, level, wing, latlong, sensor_type
FROM (SELECT s.*, unnest(generate_series(TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}', INTERVAL 1 DAY)) AS d
      FROM sensors s)""",
)
def daily_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(topology.daily_topology(tb.sensors(spark, sf_dir), as_of=tb.AS_OF))


@query(
    "topology_distinct",
    sql_with(SQL_READINGS, SQL_SENSORS)
    + "SELECT * FROM sensors WHERE sensor_id IN (SELECT sensor_id FROM readings)",
)
def topology_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.sensors_seen(tb.readings(spark, sf_dir), tb.sensors(spark, sf_dir))


FILTER_WING = "AUTOMOBILE"


@query(
    "hive_filtered_average",
    sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED)
    + _hive_sql(f"(SELECT * FROM joined WHERE wing = '{FILTER_WING}')", True),
)
def hive_filtered_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    sensors = tb.sensors(spark, sf_dir).where(F.col("wing") == FILTER_WING)
    return aggregate.hive_average(_joined(spark, sf_dir, sensors=sensors))


SUBDAY_FROM, SUBDAY_TO = "2024-01-29 06:00:00", "2024-01-29 18:00:00"


@query(
    "subday_average",
    sql_with(SQL_READINGS, SQL_SENSORS, SQL_JOINED)
    + _hive_sql(
        f"(SELECT * FROM joined WHERE time >= TIMESTAMP '{SUBDAY_FROM}' AND time < TIMESTAMP '{SUBDAY_TO}')",
        True,
    ),
)
def subday_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = F.lit(SUBDAY_FROM).cast("timestamp")
    hi = F.lit(SUBDAY_TO).cast("timestamp")
    readings = tb.readings(spark, sf_dir).where((F.col("time") >= lo) & (F.col("time") < hi))
    return aggregate.hive_average(_joined(spark, sf_dir, readings=readings))


# --------------------------------------------------------------------------
# Calendar buckets

_SQL_BUCKET = {
    "second": "date_trunc('second', ts)",
    "minute": "date_trunc('minute', ts)",
    "hour": "date_trunc('hour', ts)",
    "half_day": "CASE WHEN hour(ts) >= 12 THEN date_trunc('day', ts) + INTERVAL 12 HOUR ELSE date_trunc('day', ts) END",
    "day": "date_trunc('day', ts)",
    "week": "date_trunc('week', ts)",
    "month": "date_trunc('month', ts)",
    "year": "date_trunc('year', ts)",
}


def _bucket_query(unit: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        r = tb.readings(spark, sf_dir)
        return tb.to_ntz(r.select("event_id", "time", bucket("time", unit).alias("bucket")))

    run.__name__ = f"bucket_{unit}"
    return run


for _unit, _expr in _SQL_BUCKET.items():
    query(
        f"bucket_{_unit}",
        f"SELECT event_id, ts AS time, {_expr} AS bucket FROM events",
    )(_bucket_query(_unit))


@query(
    "bucket_epochs",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, "
    + ", ".join(f"CAST(epoch({expr}) AS BIGINT) AS {unit}_start" for unit, expr in _SQL_BUCKET.items())
    + " FROM events",
)
def bucket_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The integer form: epoch seconds to the epoch seconds of every unit's start."""
    r = tb.readings(spark, sf_dir).select("event_id", F.unix_seconds("time").alias("seconds"))
    return r.select("*", *[bucket_epoch("seconds", unit).alias(f"{unit}_start") for unit in _SQL_BUCKET])


# --------------------------------------------------------------------------
# Messages: parse, validate, choose the value, project, encode

SQL_REC = f"""
rec AS (
  SELECT CAST(e.event_id AS VARCHAR) AS key, e.event_id, e.event_type,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         {sql_uuid('e.user_id')} AS sensor_id, e.ts,
         c.c_nationkey AS hive, CAST(floor(c.c_acctbal / 1000) AS INTEGER) AS level,
         c.c_mktsegment AS wing,
         CAST(CAST(c.c_acctbal / 100 AS FLOAT) AS VARCHAR) || ', '
           || CAST(CAST(c.c_custkey / 1000 AS FLOAT) AS VARCHAR) AS latlong,
         CASE e.event_type WHEN 'click' THEN 'Temperature' WHEN 'view' THEN 'Humidity'
              WHEN 'purchase' THEN 'Movement' ELSE 'Pressure' END AS sensor_type,
         CASE e.event_type WHEN 'click' THEN CAST(e.value AS FLOAT)
              WHEN 'view' THEN CAST(e.value * 2 AS FLOAT)
              WHEN 'purchase' THEN CAST(floor(e.value) AS FLOAT) END AS value
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""

SQL_GOOD = """
good AS (
  SELECT key, sensor_id, date_trunc('day', t) AS bucket_ts, t AS time, hive, level, wing,
         sensor_type, value, latlong, CAST(t AS DATE) AS bucket_date
  FROM (SELECT *, date_trunc('millisecond', ts) AS t FROM rec)
  WHERE event_type IN ('click', 'view', 'purchase') AND k NOT IN (1, 2, 3))"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.sensor_messages(spark, sf_dir).select("key", "value")


@query("parse_readings", sql_with(SQL_REC, SQL_GOOD) + "SELECT * FROM good")
def parse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ingest.parse_messages(_messages(spark, sf_dir))
    return tb.to_ntz(ingest.to_readings(parsed, keep=["key"]))


@query(
    "parse_readings_strict",
    sql_with(SQL_REC)
    + """
SELECT r.key, sensor_id, date_trunc('day', t) AS bucket_ts, t AS time, hive, level, wing,
       CASE r.event_type WHEN 'signup' THEN 'Temperature' WHEN 'error' THEN 'Humidity' ELSE sensor_type END AS sensor_type,
       CASE r.event_type WHEN 'signup' THEN CAST(e.value AS FLOAT) WHEN 'error' THEN CAST(e.value * 2 AS FLOAT)
            ELSE r.value END AS value,
       latlong, CAST(t AS DATE) AS bucket_date
FROM (SELECT *, date_trunc('millisecond', ts) AS t FROM rec) r JOIN events e ON e.event_id = r.event_id""",
)
def parse_readings_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mode over the messages of every event, without injected faults."""
    msgs = ingest.encode_messages(tb.sensor_records(spark, sf_dir, tb.ALL_SENSOR_TYPES))
    return tb.to_ntz(ingest.to_readings(ingest.parse_messages(msgs, strict=True), strict=True, keep=["key"]))


@query(
    "quarantine_readings",
    sql_with(SQL_REC)
    + """
SELECT key, reason FROM (
  SELECT key, CASE WHEN event_type = 'error' OR k = 1 THEN 'malformed'
                   WHEN k = 2 THEN 'missing_field'
                   WHEN k = 3 THEN 'bad_sensor_id'
                   WHEN event_type = 'signup' THEN 'bad_sensor_type' END AS reason
  FROM rec) WHERE reason IS NOT NULL""",
)
def quarantine_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ingest.parse_messages(_messages(spark, sf_dir))
    return ingest.quarantined(parsed).select("key", "reason")


@query("pick_reading", sql_with(SQL_REC) + "SELECT key, sensor_type, value FROM rec")
def pick_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = tb.sensor_records(spark, sf_dir)
    return r.select("key", "sensor_type", pick_value("sensor_type").alias("value"))


@query("reading_latlong", sql_with(SQL_REC) + "SELECT key, latlong FROM rec")
def reading_latlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = tb.sensor_records(spark, sf_dir)
    return r.select("key", latlong("latitude", "longitude").alias("latlong"))





@query(
    "valid_sensor_id",
    sql_with(SQL_REC)
    + f"""
SELECT key, serial_number,
       CASE WHEN regexp_matches(lower(serial_number), '{UUID_PATTERN}')
            THEN lower(serial_number) END AS sensor_id
FROM (SELECT key, CASE WHEN k = 3 THEN 'abc' WHEN k = 4 THEN upper(sensor_id)
                       WHEN k = 5 THEN substr(sensor_id, 1, 35) WHEN k = 6 THEN ' ' || sensor_id
                       ELSE sensor_id END AS serial_number FROM rec)""",
)
def valid_sensor_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = tb.sensor_records(spark, sf_dir)
    s = F.col("serial_number")
    k = F.col("k")
    serial = (
        F.when(k == 3, F.lit("abc"))
        .when(k == 4, F.upper(s))
        .when(k == 5, F.substring(s, 1, 35))
        .when(k == 6, F.concat(F.lit(" "), s))
        .otherwise(s)
    )
    out = r.select("key", serial.alias("serial_number"))
    return out.withColumn("sensor_id", readings_fn.sensor_id("serial_number"))


SQL_PROJECTION = """
SELECT key, sensor_id, date_trunc('day', ts) AS bucket_ts, ts AS time, hive, level, wing,
       sensor_type, value, latlong, CAST(ts AS DATE) AS bucket_date
FROM rec"""


@query("readings_projection", sql_with(SQL_REC) + SQL_PROJECTION)
def readings_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(ingest.to_readings(tb.sensor_records(spark, sf_dir), keep=["key"]))


@query(
    "encode_readings",
    sql_with(SQL_REC)
    + """
SELECT key, sensor_id, date_trunc('day', ts) AS bucket_ts, date_trunc('millisecond', ts) AS time,
       hive, level, wing, sensor_type, value, latlong
FROM rec""",
)
def encode_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = ingest.to_readings(tb.sensor_records(spark, sf_dir), keep=["key"])
    encoded = ingest.encode_readings(projected, keep=["key"])
    return tb.to_ntz(ingest.decode_readings(encoded, keep=["key"]))


# --------------------------------------------------------------------------
# Upsert and streaming ingest

UPSERT_COLUMNS = ("event_id", "sensor_id", "bucket_ts", "time", "sensor_type", "value", "bucket_date")
CORRECTION_OFFSET = 1_000_000_000


@query(
    "upsert_readings",
    sql_with(SQL_READINGS)
    + f"""
, allr AS (
  SELECT {', '.join(UPSERT_COLUMNS)} FROM readings
  UNION ALL
  SELECT event_id + {CORRECTION_OFFSET}, sensor_id, bucket_ts, time, sensor_type,
         CAST(CAST(value AS DOUBLE) + 1 AS FLOAT), bucket_date
  FROM readings WHERE sensor_type = 'click')
SELECT {', '.join(UPSERT_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, bucket_ts, time ORDER BY event_id DESC) AS rn
  FROM allr) WHERE rn = 1""",
)
def upsert_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all readings into a day-partitioned table, then upsert corrections."""
    base = tb.readings(spark, sf_dir).select(*UPSERT_COLUMNS)
    path = work_path(spark, "tables", "upsert_readings")
    upsert.upsert_partitions(base, path, READING_KEY, ["event_id"])
    corrections = base.where(F.col("sensor_type") == "click").select(
        (F.col("event_id") + CORRECTION_OFFSET).alias("event_id"),
        "sensor_id", "bucket_ts", "time", "sensor_type",
        (F.col("value").cast("double") + 1).cast("float").alias("value"),
        "bucket_date",
    )
    upsert.upsert_partitions(corrections, path, READING_KEY, ["event_id"])
    return tb.to_ntz(upsert.read_table(spark, path, base.schema))


def _files_per_trigger(spark: SparkSession) -> int:
    """A micro-batch of about half as many files as there are task slots (feeds are written by all of them)."""
    return max(2, spark.sparkContext.defaultParallelism // 2)


# Shuffled (compressed) bytes that one task joins, or sorts into week folders, uncompressed.
WEEK_PARTITION_BYTES = "16m"
_PARTITION_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _by_week(spark: SparkSession, rows: DataFrame, time_col: str) -> Iterator[DataFrame]:
    """The rows of one week after the other, in time order.

    They are written once, a folder per week: each week is then read from its
    folder alone, by as many tasks as it has data for.
    """
    staged = work_path(spark, "feeds", "weeks")
    dated = rows.withColumn("_week", bucket(time_col, "week").cast("date"))
    old = spark.conf.get(_PARTITION_BYTES)
    spark.conf.set(_PARTITION_BYTES, WEEK_PARTITION_BYTES)
    try:
        # Adaptive execution splits a large week, so a task's share does not grow with the input.
        dated.hint("rebalance", "_week").write.partitionBy("_week").parquet(staged)
    finally:
        spark.conf.set(_PARTITION_BYTES, old)
    stored = spark.read.schema(dated.schema).parquet(staged)
    # the week starts of the data: one value per week
    weeks = [r[0] for r in stored.select("_week").distinct().collect()]
    for w in sorted(weeks, key=lambda w: (w is None, w)):
        yield stored.where(F.col("_week").eqNullSafe(F.lit(w).cast("date"))).select(*rows.columns)


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _run_ingest_stream(
    spark: SparkSession, sf_dir: str, by_week: bool = False
) -> stream_ingest.IngestPaths:
    feed = work_path(spark, "feeds")
    msgs = tb.sensor_messages(spark, sf_dir)
    paths = stream_ingest.IngestPaths(
        table=work_path(spark, "tables", "sensor_data"),
        quarantine=work_path(spark, "tables", "quarantine"),
        counts=work_path(spark, "tables", "batch_counts"),
        checkpoint=work_path(spark, "checkpoints"),
    )
    if by_week:
        # A week's files arrive, and the stream goes on from its checkpoint with all
        # of them at once: micro-batch i is week i, however many files it has.
        for week in _by_week(spark, msgs.select("value", "event_ts"), "event_ts"):
            week.select("value").write.mode("append").text(feed)
            stream = stream_ingest.message_stream(spark, "text", feed)
            _finish(stream_ingest.start_ingest(stream, paths, trigger={"availableNow": True}))
        return paths
    msgs.select("value").write.text(feed)
    stream = stream_ingest.message_stream(spark, "text", feed, max_files_per_trigger=_files_per_trigger(spark))
    _finish(stream_ingest.start_ingest(stream, paths, trigger={"availableNow": True}))
    return paths


STORED_COLUMNS = (
    "sensor_id", "bucket_ts", "time", "hive", "level", "wing", "sensor_type", "value", "latlong",
    "bucket_date",
)


@query(
    "stream_ingest_readings",
    sql_with(SQL_REC, SQL_GOOD) + f"SELECT {', '.join(STORED_COLUMNS)} FROM good",
)
def stream_ingest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the feed into the table, compact its (now closed) days, read it back."""
    paths = _run_ingest_stream(spark, sf_dir)
    stream_ingest.compact(spark, paths.table, upsert.list_partitions(spark, paths.table))
    return tb.to_ntz(stream_ingest.read_readings(spark, paths.table).select(*STORED_COLUMNS))


@query(
    "stream_batch_counts",
    sql_with(SQL_REC)
    + """
, w AS (
  SELECT date_trunc('week', ts) AS wk,
         CASE WHEN event_type = 'error' OR k = 1 THEN 'malformed'
              WHEN k = 2 THEN 'missing_field'
              WHEN k = 3 THEN 'bad_sensor_id'
              WHEN event_type = 'signup' THEN 'bad_sensor_type' END AS reason
  FROM rec)
SELECT CAST(dense_rank() OVER (ORDER BY wk) - 1 AS BIGINT) AS batch_id,
       CAST(count(*) AS BIGINT) AS lines,
       CAST(count_if(reason IS NULL) AS BIGINT) AS good,
       CAST(count_if(reason IS NOT NULL) AS BIGINT) AS quarantined
FROM w GROUP BY wk""",
)
def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, stored and quarantined messages of each micro-batch (one week each)."""
    paths = _run_ingest_stream(spark, sf_dir, by_week=True)
    return stream_ingest.read_counts(spark, paths.counts)


# --------------------------------------------------------------------------
# Event-time windows

SQL_WINDOW_READINGS = f"""
wr AS (SELECT ts, event_type AS sensor_type, CAST(value AS FLOAT) AS value,
              date_trunc('hour', ts) AS h FROM events)"""


@query(
    "window_tumbling",
    sql_with(SQL_WINDOW_READINGS)
    + f"""
SELECT h AS window_start, h + INTERVAL 1 HOUR AS window_end, sensor_type,
       count(value) AS n, {sql_fixed_sum('value')} AS total
FROM wr GROUP BY h, sensor_type""",
)
def window_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(windows.windowed(tb.readings(spark, sf_dir), "time", "1 hour", keys=["sensor_type"]))


# The feed is written in event-time order, one week after the other; the
# stream takes the files of a whole week as one micro-batch, so a watermark of
# one hour closes windows as the weeks go by and no row arrives late.
STREAM_WINDOW_DELAY = "1 hour"


@query("stream_window_tumbling", ORACLE["window_tumbling"])
def stream_window_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly windows computed by a stream over time-ordered reading files."""
    readings = tb.readings(spark, sf_dir).select("time", "sensor_type", "value")
    out = _run_windows(spark, readings, "1 hour", ["sensor_type"])
    return tb.to_ntz(out.select("window_start", "window_end", "sensor_type", "n", "total"))


def _run_windows(spark: SparkSession, readings: DataFrame, duration: str, keys) -> DataFrame:
    feed = work_path(spark, "feeds", "readings")
    table, checkpoint = work_path(spark, "tables", "windows"), work_path(spark, "checkpoints")
    for week in _by_week(spark, readings, "time"):
        week.write.mode("append").parquet(feed)
        q = stream_windows.start_windowed(
            spark.readStream.schema(readings.schema).parquet(feed), "time", duration, table, checkpoint,
            keys=keys, delay=STREAM_WINDOW_DELAY, trigger={"availableNow": True},
        )
        _finish(q)
    return stream_windows.read_windows(spark, table, keys)


@query(
    "window_sliding",
    sql_with(SQL_WINDOW_READINGS)
    + f"""
SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, sensor_type,
       count(value) AS n, {sql_fixed_sum('value')} AS total
FROM (SELECT CASE WHEN o = 0 THEN h ELSE h - INTERVAL 1 HOUR END AS ws, sensor_type, value
      FROM (SELECT *, unnest([0, 1]) AS o FROM wr))
GROUP BY ws, sensor_type""",
)
def window_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = tb.readings(spark, sf_dir)
    return tb.to_ntz(windows.windowed(r, "time", "2 hours", "1 hour", keys=["sensor_type"]))


# --------------------------------------------------------------------------
# Summaries

_HALF_DAY_SQL = "CASE WHEN hour(time) >= 12 THEN date_trunc('day', time) + INTERVAL 12 HOUR ELSE date_trunc('day', time) END"


def _summary_sql(precision: int) -> str:
    unit = summaries.PRECISION_UNITS[precision]
    return f"""
SELECT r.sensor_id, {_HALF_DAY_SQL} AS bucket_ts, {precision} AS precision,
       date_trunc('{unit}', time) AS time, s.hive, s.level, s.wing, r.sensor_type, s.latlong,
       {sql_fixed_sum('value')} AS value_sum, count(value) AS value_count
FROM readings r LEFT JOIN sensors s ON r.sensor_id = s.sensor_id
GROUP BY ALL"""


def _sensor_summary(spark: SparkSession, sf_dir: str, precision: int) -> DataFrame:
    return summaries.sensor_summary(tb.readings(spark, sf_dir), precision, sensors=tb.sensors(spark, sf_dir))


@query("sensor_summary_minute", sql_with(SQL_READINGS, SQL_SENSORS) + _summary_sql(60))
def sensor_summary_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(_sensor_summary(spark, sf_dir, 60))


@query("sensor_summary_hour", sql_with(SQL_READINGS, SQL_SENSORS) + _summary_sql(3600))
def sensor_summary_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(_sensor_summary(spark, sf_dir, 3600))


@query("stream_sensor_summary_minute", sql_with(SQL_READINGS, SQL_SENSORS) + _summary_sql(60))
def stream_sensor_summary_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-sensor minute summary kept by a stream (1-minute windows)."""
    readings = tb.readings(spark, sf_dir).select("sensor_id", "time", "sensor_type", "value")
    windows_ = _run_windows(spark, readings, "1 minute", ["sensor_id", "sensor_type"])
    summary = summaries.summary_from_windows(windows_, 60, sensors=tb.sensors(spark, sf_dir))
    return tb.to_ntz(summary)


@query("summary_rollup", sql_with(SQL_READINGS, SQL_SENSORS) + _summary_sql(3600))
def summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour summary re-aggregated from the minute summary."""
    minute = _sensor_summary(spark, sf_dir, 60)
    return tb.to_ntz(summaries.rollup_sensor_summary(minute, 3600))


@query(
    "hive_summary",
    sql_with(SQL_READINGS, SQL_SENSORS)
    + f", ss AS ({_summary_sql(60)})"
    + f"""
SELECT hive, bucket_ts, precision, level, time, sensor_type,
       {sql_fixed_sum('value_sum')} AS value_sum, CAST(sum(value_count) AS BIGINT) AS value_count
FROM ss GROUP BY hive, bucket_ts, precision, level, time, sensor_type""",
)
def hive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.to_ntz(summaries.hive_summary(_sensor_summary(spark, sf_dir, 60)))


RETENTION_AS_OF = "2024-04-15"


@query(
    "retention_filter",
    sql_with(SQL_READINGS)
    + f"""
SELECT sensor_id, time, sensor_type, value, bucket_date FROM readings
WHERE time >= CAST(DATE '{RETENTION_AS_OF}' - INTERVAL {retention.RAW_DAYS} DAY AS TIMESTAMP)""",
)
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = retention.retained(tb.readings(spark, sf_dir), as_of=RETENTION_AS_OF)
    return tb.to_ntz(kept.select("sensor_id", "time", "sensor_type", "value", "bucket_date"))


# --------------------------------------------------------------------------
# Transactions

SQL_TXN = """
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS txn_id, CAST(user_id AS VARCHAR) AS cc_no,
         CAST(user_id AS VARCHAR) AS user_id, ts AS txn_time, value AS amount,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS init_status
  FROM events),
flagged AS (
  SELECT *, CASE WHEN init_status < 5 THEN 'REJECTED' WHEN init_status >= 5 THEN 'ACCEPTED' END AS status
  FROM txn)"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_ops.flag(tb.transactions_input(spark, sf_dir))


@query("txn_flag", sql_with(SQL_TXN) + "SELECT txn_id, init_status, status FROM flagged")
def txn_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("txn_id", "init_status", "status")


TXN_CALENDAR_COLUMNS = (
    "txn_id", "cc_no", "user_id", "year", "month", "day", "hour", "min", "date_text",
    "txn_time", "amount", "status",
)


@query(
    "txn_calendar",
    sql_with(SQL_TXN)
    + """
SELECT txn_id, cc_no, user_id, CAST(year(txn_time) AS INTEGER) AS year,
       CAST(month(txn_time) AS INTEGER) AS month, CAST(day(txn_time) AS INTEGER) AS day,
       CAST(hour(txn_time) AS INTEGER) AS hour, CAST(minute(txn_time) AS INTEGER) AS min,
       strftime(txn_time, '%Y-%m-%d') AS date_text, txn_time, amount, status
FROM flagged""",
)
def txn_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = txn_ops.to_transactions(_flagged(spark, sf_dir))
    return tb.to_ntz(stored.select(*TXN_CALENDAR_COLUMNS))


@query(
    "txn_count_min",
    sql_with(SQL_TXN)
    + """
, m AS (
  SELECT CAST(year(txn_time) AS INTEGER) AS year, CAST(month(txn_time) AS INTEGER) AS month,
         CAST(day(txn_time) AS INTEGER) AS day, CAST(hour(txn_time) AS INTEGER) AS hour,
         CAST(minute(txn_time) AS INTEGER) AS minute,
         CAST(count(*) AS INTEGER) AS ttl_txn_min,
         CAST(count_if(status = 'ACCEPTED') AS INTEGER) AS approved_txn_min
  FROM flagged GROUP BY ALL),
h AS (
  SELECT *, CAST(sum(ttl_txn_min) OVER (PARTITION BY year, month, day, hour) AS INTEGER) AS ttl_txn_hr,
         CAST(sum(approved_txn_min) OVER (PARTITION BY year, month, day, hour) AS INTEGER) AS approved_txn_hr
  FROM m)
SELECT year, month, day, hour, minute,
       approved_txn_hr / ttl_txn_hr AS approved_rate_hr,
       approved_txn_min / ttl_txn_min AS approved_rate_min,
       approved_txn_hr, approved_txn_min, ttl_txn_hr, ttl_txn_min
FROM h""",
)
def txn_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_ops.txn_count_min(_flagged(spark, sf_dir))


def _run_txn_stream(
    spark: SparkSession, sf_dir: str, bad: DataFrame | None = None, keep_minutes: bool = False
) -> stream_txn.TxnPaths:
    feed = work_path(spark, "feeds", "transactions")
    msgs = txn_ops.encode_transactions(tb.transactions_input(spark, sf_dir))
    spread(msgs).write.text(feed)
    # Some messages are sent a second time: each transaction still counts once.
    again = msgs.where(F.pmod(F.xxhash64("value"), F.lit(4)) == 0)
    again.write.mode("append").text(feed)
    if bad is not None:
        bad.write.mode("append").text(feed)
    paths = stream_txn.TxnPaths(
        table=work_path(spark, "tables", "transactions"),
        counts=work_path(spark, "tables", "txn_lines"),
        checkpoint=work_path(spark, "checkpoints"),
        minutes=work_path(spark, "tables", "txn_minutes") if keep_minutes else "",
    )
    stream = stream_ingest.message_stream(spark, "text", feed, max_files_per_trigger=_files_per_trigger(spark))
    q = stream_txn.start_txn_ingest(stream, paths, trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return paths


@query(
    "stream_txn_ingest",
    sql_with(SQL_TXN)
    + """
SELECT txn_id, cc_no, user_id, CAST(year(txn_time) AS INTEGER) AS year,
       CAST(month(txn_time) AS INTEGER) AS month, CAST(day(txn_time) AS INTEGER) AS day,
       CAST(hour(txn_time) AS INTEGER) AS hour, CAST(minute(txn_time) AS INTEGER) AS min,
       strftime(txn_time, '%Y-%m-%d') AS date_text, date_trunc('millisecond', txn_time) AS txn_time,
       amount, status
FROM flagged""",
)
def stream_txn_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions streamed as JSON, flagged, stored and read back."""
    paths = _run_txn_stream(spark, sf_dir)
    return tb.to_ntz(stream_txn.read_transactions(spark, paths.table).select(*TXN_CALENDAR_COLUMNS))


@query("stream_txn_count_min", ORACLE["txn_count_min"])
def stream_txn_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-minute approval rollup kept by the transaction stream."""
    paths = _run_txn_stream(spark, sf_dir)
    return stream_txn.read_txn_count_min(spark, paths.table)


@query(
    "stream_txn_quarantine",
    """
SELECT '{"txn_id": "' || event_id || '"' AS value, 'malformed' AS reason FROM events WHERE event_id % 10 = 0
UNION ALL
SELECT '{"notes": "' || event_id || '"}', 'missing_field' FROM events WHERE event_id % 10 = 1""",
)
def stream_txn_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages the transaction stream could not store (cut short, or without an id), with the reason."""
    e = tb.table(spark, sf_dir, "events")
    cut = e.where("event_id % 10 = 0").select(F.concat(F.lit('{"txn_id": "'), "event_id", F.lit('"')).alias("value"))
    no_id = e.where("event_id % 10 = 1").select(F.concat(F.lit('{"notes": "'), "event_id", F.lit('"}')).alias("value"))
    paths = _run_txn_stream(spark, sf_dir, cut.unionByName(no_id))
    return stream_txn.read_txn_quarantine(spark, paths.quarantine).select("value", "reason")


SQL_BASKET_ITEMS = f"""
p AS (
  SELECT l_orderkey, 'Item_' || CAST(l_partkey AS VARCHAR) AS item,
         {sql_fixed_sum('l_extendedprice')} AS price
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tb.table(spark, sf_dir, "lineitem")
    return txn_ops.baskets(lines, "l_orderkey", "l_partkey", "l_extendedprice")


@query(
    "basket_render",
    sql_with(SQL_BASKET_ITEMS)
    + """
SELECT l_orderkey, string_agg(item || '->' || printf('%1.2f', price), ',' ORDER BY item) AS items_text
FROM p GROUP BY l_orderkey""",
)
def basket_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_ops.basket_text(_baskets(spark, sf_dir), "l_orderkey")


@query("basket_parse", sql_with(SQL_BASKET_ITEMS) + "SELECT l_orderkey, item, price FROM p")
def basket_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = txn_ops.basket_text(_baskets(spark, sf_dir), "l_orderkey")
    entries = text.select("l_orderkey", F.explode(item_entries("items_text")).alias("e"))
    return entries.select("l_orderkey", "e.item", "e.price")


@query(
    "basket_total",
    sql_with(SQL_BASKET_ITEMS)
    + """
SELECT l_orderkey, total, printf('%1.2f', total) AS total_text FROM (
  SELECT l_orderkey, CAST(sum(CAST(round(price * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
  FROM p GROUP BY l_orderkey)""",
)
def basket_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_ops.basket_totals(_baskets(spark, sf_dir), "l_orderkey")


# --------------------------------------------------------------------------
# Range lookup


def nation_share_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative share of customers per nation, in nation-key order: (hi, name)."""
    counts = tb.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nation = tb.table(spark, sf_dir, "nation")
    named = join_small(counts, nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
    # One row per nation: the window below runs over at most a few hundred rows.
    running = Window.orderBy("c_nationkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(1))
    return named.select(
        (F.sum("n").over(running) / F.sum("n").over(everything)).alias("hi"),
        F.col("n_name").alias("name"),
    )


@query(
    "range_lookup",
    """
WITH cnt AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey),
b AS (SELECT n_name AS name, sum(n) OVER (ORDER BY c_nationkey) / sum(n) OVER () AS hi
      FROM cnt JOIN nation ON c_nationkey = n_nationkey),
bl AS (SELECT name, hi, lag(hi) OVER (ORDER BY hi) AS lo FROM b),
pr AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) / 100 AS u FROM events)
SELECT pr.event_id, pr.u, coalesce(bl.name, 'All Other') AS name
FROM pr LEFT JOIN bl ON (bl.lo IS NULL OR pr.u > bl.lo) AND pr.u <= bl.hi""",
)
def range_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.table(spark, sf_dir, "events").select(
        "event_id", (tb.props_k() / 100).alias("u")
    )
    bounds = nation_share_bounds(spark, sf_dir)
    return lookup.range_lookup(events, "u", bounds).select("event_id", "u", "name")
