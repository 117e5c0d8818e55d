"""Event-time windows: tumbling and sliding counts and sums.

``windowed`` works on batch and streaming DataFrames alike. On a stream,
call it after ``with_watermark`` so the state of closed windows is dropped;
the event-time column must be a TIMESTAMP (not TIMESTAMP_NTZ) for that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.operators.aggregate import finite, fixed_sum


def with_watermark(df: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Watermark on ``time_col``, cast to TIMESTAMP (UTC) when needed."""
    if df.schema[time_col].dataType.simpleString() == "timestamp_ntz":
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return df.withWatermark(time_col, delay)


def windowed(
    df: DataFrame,
    time_col: str,
    duration: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    value: str = "value",
    exact: bool = True,
) -> DataFrame:
    """(window_start, window_end, keys, n, total) per event-time window."""
    w = F.window(time_col, duration, slide) if slide else F.window(time_col, duration)
    return (
        df.groupBy(w.alias("w"), *keys)
        .agg(F.count(finite(value)).alias("n"), fixed_sum(value, exact).alias("total"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *keys,
            "n",
            "total",
        )
    )
