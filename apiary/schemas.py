"""Fixed schemas of every message and table the library reads or writes.

Nothing is inferred: each input is read with one of these ``StructType``
constants. Column names are snake_case throughout.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Incoming JSON sensor snapshot, one object per message.
SENSOR_MESSAGE = T.StructType(
    [
        T.StructField("serial_number", T.StringType()),
        T.StructField("sensor_snapshot", T.TimestampType()),
        T.StructField("floor", T.IntegerType()),
        T.StructField("hive_num", T.IntegerType()),
        T.StructField("humidity", T.FloatType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("main_history", T.ArrayType(T.StringType())),
        T.StructField("manuf_date", T.TimestampType()),
        T.StructField("movement", T.IntegerType()),
        T.StructField("retired", T.BooleanType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("temperature", T.FloatType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("wing", T.StringType()),
    ]
)

# Fields a message must carry; `main_history` is optional.
REQUIRED_MESSAGE_FIELDS: tuple[str, ...] = tuple(
    f.name for f in SENSOR_MESSAGE.fields if f.name != "main_history"
)

# Pattern of the two date fields in a message (fixed value).
MESSAGE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# The sensor types and the message field each one reads (fixed values).
SENSOR_TYPE_FIELDS: dict[str, str] = {
    "Temperature": "temperature",
    "Humidity": "humidity",
    "Movement": "movement",
}

# One stored reading: one row per sensor and instant.
READING = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("bucket_ts", T.TimestampType(), False),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("hive", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("wing", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value", T.FloatType()),
        T.StructField("latlong", T.StringType()),
    ]
)
READING_KEY: tuple[str, ...] = ("sensor_id", "bucket_ts", "time")
READING_PARTITION = "bucket_date"

# Sensor dimension: one row per sensor.
SENSOR = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("hive", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("wing", T.StringType()),
        T.StructField("latlong", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
    ]
)

# Per-sensor summary, precision in seconds (60 or 3600).
SENSOR_SUMMARY = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("bucket_ts", T.TimestampType(), False),
        T.StructField("precision", T.IntegerType(), False),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("hive", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("wing", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("latlong", T.StringType()),
        T.StructField("value_sum", T.DoubleType()),
        T.StructField("value_count", T.LongType()),
    ]
)

# Per-hive and level summary.
HIVE_SUMMARY = T.StructType(
    [
        T.StructField("hive", T.IntegerType()),
        T.StructField("bucket_ts", T.TimestampType(), False),
        T.StructField("precision", T.IntegerType(), False),
        T.StructField("level", T.IntegerType()),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value_sum", T.DoubleType()),
        T.StructField("value_count", T.LongType()),
    ]
)

# Card transaction, calendar split kept next to the instant.
TRANSACTION = T.StructType(
    [
        T.StructField("cc_no", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("txn_time", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("cc_provider", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("date_text", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("items", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("location", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("min", T.IntegerType()),
        T.StructField("notes", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("txn_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
    ]
)
TRANSACTION_KEY: tuple[str, ...] = ("cc_no", "year", "month", "day", "txn_time")

# Incoming JSON transaction message (initial status before flagging).
TXN_MESSAGE = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("cc_no", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("txn_time", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("init_status", T.IntegerType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("items", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("cc_provider", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("notes", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

# Fields a transaction message must carry: its id, and the parts of the stored key.
REQUIRED_TXN_FIELDS: tuple[str, ...] = ("txn_id", "cc_no", "txn_time")

# Per-minute approval rollup.
TXN_COUNT_MIN = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("minute", T.IntegerType()),
        T.StructField("approved_rate_hr", T.DoubleType()),
        T.StructField("approved_rate_min", T.DoubleType()),
        T.StructField("approved_txn_hr", T.IntegerType()),
        T.StructField("approved_txn_min", T.IntegerType()),
        T.StructField("ttl_txn_hr", T.IntegerType()),
        T.StructField("ttl_txn_min", T.IntegerType()),
    ]
)

# Place of a message in its source; compared field by field (see `sources.messages`).
SOURCE_POS = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)

# Bounds table of a range lookup: interval (previous hi, hi].
RANGE_BOUNDS = T.StructType(
    [
        T.StructField("hi", T.DoubleType(), False),
        T.StructField("name", T.StringType()),
    ]
)
