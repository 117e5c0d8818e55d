"""Round instants down to calendar units (UTC).

``bucket(col, unit)`` is one column expression for all eight units a reading
may be bucketed by; every branch is a built-in Spark expression, so it stays
inside whole-stage codegen and works the same in batch and streaming plans.

Rounding is always *down* (towards the past), also before 1970. Weeks start on
Monday. The session time zone must be UTC (``apiary.session`` sets it), as the
day, week, month and year branches use the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted unit names and their aliases (fixed values).
_UNIT_ALIASES: dict[str, str] = {
    "second": "second",
    "seconds": "second",
    "minute": "minute",
    "minutes": "minute",
    "hour": "hour",
    "hours": "hour",
    "half_day": "half_day",
    "half_days": "half_day",
    "halfday": "half_day",
    "day": "day",
    "days": "day",
    "week": "week",
    "weeks": "week",
    "month": "month",
    "months": "month",
    "year": "year",
    "years": "year",
}

UNITS: tuple[str, ...] = ("second", "minute", "hour", "half_day", "day", "week", "month", "year")

# Length in seconds of the fixed-length units.
UNIT_SECONDS: dict[str, int] = {
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "half_day": 43200,
    "day": 86400,
    "week": 604800,
}


def normalize_unit(unit: str) -> str:
    """Canonical unit name; raises ``ValueError`` for anything else."""
    key = str(unit).strip().lower()
    if key not in _UNIT_ALIASES:
        raise ValueError(f"unsupported unit {unit!r}; expected one of {', '.join(UNITS)}")
    return _UNIT_ALIASES[key]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(ts: Column | str, unit: str) -> Column:
    """Start of the ``unit`` period holding ``ts`` (a TIMESTAMP column)."""
    unit = normalize_unit(unit)
    ts = _col(ts)
    if unit == "half_day":
        # 00:00 or 12:00 of the same day; arithmetic on epoch seconds rounds
        # down for negative values too (pmod is never negative).
        secs = F.unix_seconds(ts.cast("timestamp"))
        return F.timestamp_seconds(secs - F.pmod(secs, F.lit(43200)))
    return F.date_trunc(unit, ts)


def bucket_epoch(seconds: Column | str, unit: str) -> Column:
    """Integer form: epoch seconds in, epoch seconds of the period start out."""
    return F.unix_seconds(bucket(F.timestamp_seconds(_col(seconds)), unit))


def bucket_date(ts: Column | str) -> Column:
    """UTC calendar day of an instant; the partition column of stored readings."""
    return F.to_date(_col(ts))
