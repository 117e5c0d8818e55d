import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from apiary.functions.buckets import UNITS, bucket, bucket_epoch, normalize_unit

T = dt.datetime(2017, 1, 29, 13, 45, 50, 500000)

EXPECTED = {
    "second": dt.datetime(2017, 1, 29, 13, 45, 50),
    "minute": dt.datetime(2017, 1, 29, 13, 45),
    "hour": dt.datetime(2017, 1, 29, 13),
    "half_day": dt.datetime(2017, 1, 29, 12),
    "day": dt.datetime(2017, 1, 29),
    "week": dt.datetime(2017, 1, 23),
    "month": dt.datetime(2017, 1, 1),
    "year": dt.datetime(2017, 1, 1),
}


def _one(spark, ts, unit):
    df = spark.createDataFrame([(ts,)], "ts timestamp")
    return df.select(bucket("ts", unit).cast("timestamp_ntz").alias("b")).first().b


@pytest.mark.parametrize("unit", UNITS)
def test_units_on_a_sunday(spark, unit):
    assert _one(spark, T, unit) == EXPECTED[unit]


def test_week_edges(spark):
    assert _one(spark, dt.datetime(1970, 1, 5), "week") == dt.datetime(1970, 1, 5)
    assert _one(spark, dt.datetime(1970, 1, 2), "week") == dt.datetime(1969, 12, 29)


def test_before_epoch_rounds_down(spark):
    assert _one(spark, dt.datetime(1969, 12, 31, 23, 59, 30), "minute") == dt.datetime(1969, 12, 31, 23, 59)
    assert _one(spark, dt.datetime(1969, 12, 31, 13, 0, 1), "half_day") == dt.datetime(1969, 12, 31, 12)


def test_unknown_unit():
    with pytest.raises(ValueError):
        normalize_unit("decade")
    assert normalize_unit("HALF_DAYS") == "half_day"


def _int_formula(t: int, unit: str) -> int:
    """Integer rounding on epoch seconds (valid for t >= 0; weeks t >= 345600)."""
    size = {"minute": 60, "hour": 3600, "half_day": 43200, "day": 86400}
    if unit == "second":
        return t
    if unit in size:
        return t // size[unit] * size[unit]
    if unit == "week":
        return (t - 345600) // 604800 * 604800 + 345600
    d = dt.datetime.fromtimestamp(t, dt.timezone.utc)
    first = dt.datetime(d.year, d.month if unit == "month" else 1, 1, tzinfo=dt.timezone.utc)
    return int(first.timestamp())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=345600, max_value=4_000_000_000), min_size=20, max_size=60))
def test_matches_integer_formula_and_properties(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "t long")
    cols = [bucket_epoch("t", u).alias(u) for u in UNITS]
    again = [bucket_epoch(F.col(u), u).alias(f"{u}_2") for u in UNITS]
    rows = df.select("t", *cols).select("t", *UNITS, *again).collect()
    for r in rows:
        for u in UNITS:
            assert r[u] == _int_formula(r.t, u)
            assert r[u] <= r.t
            assert r[f"{u}_2"] == r[u]
