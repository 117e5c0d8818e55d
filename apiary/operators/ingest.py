"""JSON sensor messages → typed, validated readings (batch and streaming).

One function pipeline serves both a batch DataFrame of messages and a
streaming one: ``from_json`` with a fixed schema, then column expressions
only, so each micro-batch compiles to one narrow, code-generated stage.

Two failure modes:

* ``quarantine`` (default): a message that is not valid JSON, has a wrongly
  typed field, misses a required field, has a bad serial number or an
  unknown sensor type gets a ``reason`` and goes to the quarantine output;
  the good rows go on.
* ``strict``: the first such message fails the query (FAILFAST parsing plus
  ``raise_error`` checks), as one bad row fails a whole batch in the
  original feed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.functions.buckets import bucket, bucket_date
from apiary.functions.readings import (
    known_sensor_type,
    latlong,
    pick_value,
    require_uuid,
    sensor_id,
)
from apiary.operators.strategy import spread
from apiary.schemas import (
    MESSAGE_TIMESTAMP_FORMAT,
    READING,
    REQUIRED_MESSAGE_FIELDS,
    SENSOR_MESSAGE,
    SOURCE_POS,
)

CORRUPT = "_corrupt_record"

# Quarantine reasons, in the order they are tested (fixed values).
MALFORMED = "malformed"
MISSING_FIELD = "missing_field"
BAD_SENSOR_ID = "bad_sensor_id"
BAD_SENSOR_TYPE = "bad_sensor_type"

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

READING_COLUMNS: tuple[str, ...] = tuple(f.name for f in READING.fields)


def _json_options(strict: bool) -> dict[str, str]:
    opts = {"timestampFormat": MESSAGE_TIMESTAMP_FORMAT}
    if strict:
        opts["mode"] = "FAILFAST"
    else:
        opts["mode"] = "PERMISSIVE"
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return opts


def message_columns(messages: DataFrame) -> list[Column]:
    """(key, value, source_pos) of any messages; rows without a place in a source are numbered as they stand."""
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    known = "source_pos" in messages.columns
    fields = [
        F.col(f"source_pos.{f.name}") if known else F.lit(None).cast(f.dataType).alias(f.name) for f in SOURCE_POS.fields
    ]
    if not messages.isStreaming:
        fields[-1] = F.coalesce(fields[-1], F.monotonically_increasing_id()).alias("row")
    pos = F.struct(*fields)
    return [key.alias("key"), F.col("value").cast("string").alias("value"), pos.cast(SOURCE_POS).alias("source_pos")]


def parse_messages(messages: DataFrame, strict: bool = False, spread_narrow: bool = True) -> DataFrame:
    """``messages(value STRING[, key, source_pos])`` → key, value, source_pos, message fields, ``reason``.

    ``reason`` is null for a good message. In strict mode a bad message
    raises instead and ``reason`` is always null. With ``spread_narrow`` a
    batch input with fewer partitions than task slots is spread first
    (:func:`apiary.operators.strategy.spread`); micro-batches pass False and
    take their parallelism from the source (topic partitions,
    ``minPartitions``, files) instead of a shuffle per trigger.
    """
    schema = SENSOR_MESSAGE
    if not strict:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    columns = message_columns(messages)
    if spread_narrow:
        # A source's positions are taken where it is read, before the rows move.
        messages = spread(messages.select(*columns))
        columns = ["key", "value", "source_pos"]
    # The parsed struct comes out of a one-element generator: filters on its
    # fields (reason IS NULL downstream) then stay above it. Without that
    # barrier the optimizer pushes such a filter below the projection and
    # copies the whole from_json into it, parsing every message twice.
    parsed = messages.select(
        *columns,
        F.explode(
            F.array(F.from_json(F.col("value").cast("string"), schema, _json_options(strict)))
        ).alias("m"),
    ).select("key", "value", "source_pos", "m.*")
    missing = None
    for name in REQUIRED_MESSAGE_FIELDS:
        cond = F.col(name).isNull()
        missing = cond if missing is None else (missing | cond)
    if strict:
        # The check rides on serial_number, which every reading selects, so
        # column pruning cannot drop it.
        checked = F.when(
            missing,
            F.raise_error(F.concat(F.lit("message misses a required field: "), F.col("value"))),
        ).otherwise(F.col("serial_number"))
        return parsed.withColumn("serial_number", checked.cast("string")).withColumn(
            "reason", F.lit(None).cast("string")
        )
    reason = (
        F.when(F.col(CORRUPT).isNotNull() | F.col("value").isNull(), F.lit(MALFORMED))
        .when(missing, F.lit(MISSING_FIELD))
        .when(sensor_id("serial_number").isNull(), F.lit(BAD_SENSOR_ID))
        .when(~known_sensor_type("sensor_type"), F.lit(BAD_SENSOR_TYPE))
    )
    return parsed.withColumn("reason", reason).drop(CORRUPT)


def to_readings(parsed: DataFrame, strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Good parsed messages → stored reading columns + ``bucket_date``."""
    good = parsed.where(F.col("reason").isNull()) if "reason" in parsed.columns and not strict else parsed
    time = F.col("sensor_snapshot")
    sid = require_uuid("serial_number") if strict else sensor_id("serial_number")
    return good.select(
        *keep,
        sid.alias("sensor_id"),
        bucket(time, "day").alias("bucket_ts"),
        time.alias("time"),
        F.col("hive_num").alias("hive"),
        F.col("floor").alias("level"),
        F.col("wing"),
        F.col("sensor_type"),
        pick_value("sensor_type", strict=strict).alias("value"),
        latlong("latitude", "longitude").alias("latlong"),
        bucket_date(time).alias("bucket_date"),
    )


def quarantined(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bad messages: raw text, key and the first reason found (and the columns ``keep``)."""
    return parsed.where(F.col("reason").isNotNull()).select("key", "value", "reason", *keep)


def readings_from_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    return to_readings(parse_messages(messages, strict), strict)


def encode_messages(
    records: DataFrame,
    keep: Sequence[str] = ("key",),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Typed message records → ``value`` JSON text (null fields omitted)."""
    fields = [F.col(f.name) for f in SENSOR_MESSAGE.fields if f.name in records.columns]
    for name, col in (extra or {}).items():
        fields.append(col.alias(name))
    body = F.to_json(F.struct(*fields), {"timestampFormat": MESSAGE_TIMESTAMP_FORMAT})
    return records.select(*[c for c in keep if c in records.columns], body.alias("value"))


def encode_readings(readings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Stored readings → JSON text, one object per reading."""
    fields = [c for c in READING_COLUMNS if c in readings.columns]
    body = F.to_json(F.struct(*fields), {"timestampFormat": MESSAGE_TIMESTAMP_FORMAT})
    return readings.select(*keep, body.alias("value"))


def decode_readings(encoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Inverse of :func:`encode_readings` (text → typed reading columns)."""
    opts = {"timestampFormat": MESSAGE_TIMESTAMP_FORMAT, "mode": "FAILFAST"}
    return encoded.select(*keep, F.from_json("value", READING, opts).alias("r")).select(*keep, "r.*")
