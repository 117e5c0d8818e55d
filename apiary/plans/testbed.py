"""How the generated test tables stand for sensors, readings and transactions.

* sensor dimension = ``customer``: ``sensor_id`` = UUID text of
  ``md5(c_custkey)``, hive = ``c_nationkey``, level = ``floor(c_acctbal /
  1000)``, wing = ``c_mktsegment``, latitude = ``c_acctbal / 100`` and
  longitude = ``c_custkey / 1000`` (as floats), sensor type ``Any`` (a
  customer emits several event types);
* readings = ``events``: sensor = ``user_id`` (same UUID mapping), time =
  ``ts`` (UTC), sensor type = ``event_type``, value = ``value`` as float;
* transactions = ``events``: card = ``user_id``, amount = ``value``, initial
  status = ``k % 10`` of ``props`` (``{"k": 0..99}``);
* sensor messages = ``events`` ⋈ ``customer`` written as JSON text by Spark,
  with data-driven faults (see :func:`sensor_messages`).

Every function reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.functions.buckets import bucket, bucket_date
from apiary.functions.readings import latlong, uuid_text
from apiary.operators.ingest import encode_messages
from apiary.operators.strategy import join_small, spread

# Reference day of the test period: the last day of the generated events.
AS_OF = "2024-01-30"

# Sensor types the event types stand for; others are unknown types (fixed values).
EVENT_SENSOR_TYPES: dict[str, str] = {
    "click": "Temperature",
    "view": "Humidity",
    "purchase": "Movement",
}
UNKNOWN_TYPE = "Pressure"
# Every event type as a known sensor type: a feed without bad messages (fixed values).
ALL_SENSOR_TYPES: dict[str, str] = EVENT_SENSOR_TYPES | {"signup": "Temperature", "error": "Humidity"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uuid_of(key) -> F.Column:
    """Deterministic UUID text of an integer key."""
    return uuid_text(F.md5(key.cast("string")))


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    lat = (F.col("c_acctbal") / 100).cast("float")
    lon = (F.col("c_custkey") / 1000).cast("float")
    return c.select(
        uuid_of(F.col("c_custkey")).alias("sensor_id"),
        F.col("c_nationkey").cast("int").alias("hive"),
        F.floor(F.col("c_acctbal") / 1000).cast("int").alias("level"),
        F.col("c_mktsegment").alias("wing"),
        latlong(lat, lon).alias("latlong"),
        F.lit("Any").alias("sensor_type"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    time = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id"),
        uuid_of(F.col("user_id")).alias("sensor_id"),
        bucket(time, "day").alias("bucket_ts"),
        time.alias("time"),
        F.col("event_type").alias("sensor_type"),
        F.col("value").cast("float").alias("value"),
        bucket_date(F.col("ts")).alias("bucket_date"),
    )


def props_k(col: str = "props") -> F.Column:
    return F.get_json_object(F.col(col), "$.k").try_cast("int")


def sensor_type_of(event_type: F.Column, types: dict[str, str] = EVENT_SENSOR_TYPES) -> F.Column:
    expr = F.lit(UNKNOWN_TYPE)
    for ev, st in types.items():
        expr = F.when(event_type == ev, F.lit(st)).otherwise(expr)
    return expr


def sensor_records(
    spark: SparkSession, sf_dir: str, types: dict[str, str] = EVENT_SENSOR_TYPES
) -> DataFrame:
    """Typed sensor snapshots (the message schema) with the event key."""
    # Messages are built per event (JSON encoding): spread a narrow scan.
    e = spread(table(spark, sf_dir, "events"), "event_id")
    c = table(spark, sf_dir, "customer")
    # customer is the dimension side, events the large side.
    j = join_small(e, c.withColumn("user_id", F.col("c_custkey")), "user_id", "inner")
    k = props_k()
    value = F.col("value")
    return j.select(
        F.col("event_id").cast("string").alias("key"),
        F.col("event_type"),
        k.alias("k"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        uuid_of(F.col("user_id")).alias("serial_number"),
        F.col("ts").cast("timestamp").alias("sensor_snapshot"),
        F.floor(F.col("c_acctbal") / 1000).cast("int").alias("floor"),
        F.col("c_nationkey").cast("int").alias("hive_num"),
        (value * 2).cast("float").alias("humidity"),
        (F.col("c_acctbal") / 100).cast("float").alias("latitude"),
        (F.col("c_custkey") / 1000).cast("float").alias("longitude"),
        F.when(F.col("event_type") != "view", F.array(F.lit("ok"))).alias("main_history"),
        F.lit("2016-05-20 00:00:00").cast("timestamp").alias("manuf_date"),
        F.floor(value).cast("int").alias("movement"),
        (k >= 50).alias("retired"),
        sensor_type_of(F.col("event_type"), types).alias("sensor_type"),
        value.cast("float").alias("temperature"),
        F.lit("v1").alias("vendor"),
        F.col("c_mktsegment").alias("wing"),
    )


def sensor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value, event_ts) JSON messages, one per event, with data-driven faults.

    ``event_ts`` is the event's instant, kept beside the text (a broken
    message has none inside) so feeds can be written in time order.

    * ``error`` events: the text is cut in half (broken JSON);
    * ``k = 1``: ``floor`` is text (wrong type);
    * ``k = 2``: ``sensor_snapshot`` is missing;
    * ``k = 3``: ``serial_number`` is ``abc``;
    * ``signup`` events: sensor type ``Pressure`` (unknown);
    * ``purchase`` events carry an extra unknown field; ``view`` events have
      no ``main_history``.
    """
    r = sensor_records(spark, sf_dir)
    r = r.withColumn(
        "sensor_snapshot", F.when(F.col("k") != 2, F.col("sensor_snapshot"))
    ).withColumn(
        "serial_number", F.when(F.col("k") == 3, F.lit("abc")).otherwise(F.col("serial_number"))
    )
    extra = F.when(F.col("event_type") == "purchase", F.lit("fw-2"))
    msg = encode_messages(r, keep=("key", "k", "event_type", "event_ts"), extra={"firmware": extra})
    text = F.col("value")
    text = F.when(
        F.col("k") == 1, F.regexp_replace(text, '"floor":(-?[0-9]+)', '"floor":"x$1"')
    ).otherwise(text)
    text = F.when(
        F.col("event_type") == "error", F.substring(text, 1, (F.length(text) / 2).cast("int"))
    ).otherwise(text)
    return msg.select("key", text.alias("value"), "event_ts")


def transactions_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions: id, card, instant, amount, initial status."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("user_id").cast("string").alias("cc_no"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("txn_time"),
        F.col("value").alias("amount"),
        (props_k() % 10).alias("init_status"),
    )


def to_ntz(df: DataFrame) -> DataFrame:
    """Instants as TIMESTAMP_NTZ wall-clock (UTC), the oracle's type."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
