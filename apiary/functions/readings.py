"""Column functions for sensor readings: position text, value choice, ids.

All are built-in Spark expressions (no Python UDF), usable in batch and
streaming plans alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from apiary.schemas import SENSOR_TYPE_FIELDS

# Canonical 8-4-4-4-12 hexadecimal UUID text (fixed value).
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latlong(latitude: Column | str, longitude: Column | str) -> Column:
    """``"<lat>, <long>"``; null when either part is null."""
    return F.concat(
        _col(latitude).cast("string"), F.lit(", "), _col(longitude).cast("string")
    )


def pick_value(
    sensor_type: Column | str,
    temperature: Column | str = "temperature",
    humidity: Column | str = "humidity",
    movement: Column | str = "movement",
    strict: bool = False,
) -> Column:
    """The reading a message carries, chosen by its sensor type.

    ``Temperature`` reads ``temperature``, ``Humidity`` reads ``humidity``,
    ``Movement`` reads ``movement`` widened to float. Any other type gives
    null, or fails the query when ``strict``.
    """
    fields = {"temperature": temperature, "humidity": humidity, "movement": movement}
    st = _col(sensor_type)
    expr = None
    for type_name, field in SENSOR_TYPE_FIELDS.items():
        value = _col(fields[field]).cast("float")
        expr = F.when(st == type_name, value) if expr is None else expr.when(st == type_name, value)
    if strict:
        return expr.otherwise(
            F.raise_error(F.concat(F.lit("unknown sensor type: "), F.coalesce(st, F.lit("null"))))
        ).cast("float")
    return expr


def known_sensor_type(sensor_type: Column | str) -> Column:
    return _col(sensor_type).isin(list(SENSOR_TYPE_FIELDS))


def sensor_id(serial_number: Column | str) -> Column:
    """Lower-case UUID text of a serial number, null when it is no UUID."""
    text = F.lower(_col(serial_number))
    return F.when(text.rlike(UUID_PATTERN), text)


def require_uuid(serial_number: Column | str) -> Column:
    """Like :func:`sensor_id`, but fails the query on a bad serial number."""
    text = F.lower(_col(serial_number))
    return F.when(text.rlike(UUID_PATTERN), text).otherwise(
        F.raise_error(F.concat(F.lit("invalid UUID: "), F.coalesce(text, F.lit("null"))))
    ).cast("string")


def uuid_text(hex32: Column | str) -> Column:
    """Format 32 hexadecimal characters as 8-4-4-4-12 UUID text."""
    h = _col(hex32)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )
