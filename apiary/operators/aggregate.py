"""Count, sum and average of reading values per group.

Sums are exact: each value is cut, at powers of two, into whole units of
2**-32, whole units of 2**30 and what is left below one unit. The units are
added as integers, so re-runs, replays and other partitionings give the same
bits, and nothing is rounded before it is added. What is left of values with
bits below 2**-32, and values from 2**92 on, are added as doubles. Every finite
double is a legal input. ``exact=False`` sums plain doubles instead.
Non-finite values (NaN, ±infinity) are left out of the sum and of the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Powers of two at which a value is cut (fixed values).
UNIT = 2.0**32
LARGE = 2.0**30
HUGE = 2.0**92


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_sum(value: Column | str, exact: bool = True) -> Column:
    """Sum of ``value`` as a double; null where no value is finite."""
    v = _col(value).cast("double")
    if not exact:
        return F.sum(v)
    # Finite values only: NaN and infinities differ from themselves by NaN.
    v = F.when(v - v == 0, v)
    # Scaling by a power of two, floor and the differences are exact in doubles.
    large = F.when((F.abs(v) >= LARGE) & (F.abs(v) < HUGE), F.floor(v / LARGE))
    near = F.when(F.abs(v) < LARGE, v).when(F.abs(v) < HUGE, v - large.cast("double") * LARGE)
    units = F.floor(near * UNIT)
    # What is left of a value below one unit, or a value beyond all units.
    left = F.coalesce(near - units.cast("double") / UNIT, v)

    small, big = (F.sum(c.cast("decimal(20,0)")) for c in (units, large))
    # Small units that add up to large ones are carried, so that nothing cancels in doubles.
    carry = F.round(small.cast("double") / (UNIT * LARGE))
    kept = small - carry.cast("decimal(18,0)") * F.lit(int(UNIT * LARGE)).cast("decimal(19,0)")
    few = (big.isNull()) & (F.abs(small.cast("double")) < UNIT * LARGE / 2)
    return F.when(few, small.cast("double") / UNIT + F.sum(left)).otherwise(
        F.coalesce(kept.cast("double") / UNIT, F.lit(0.0))
        + (F.coalesce(big.cast("double"), F.lit(0.0)) + F.coalesce(carry, F.lit(0.0))) * LARGE
        + F.sum(left)
    )


def finite(value: Column | str) -> Column:
    """The value, or null where it is NaN or infinite."""
    v = _col(value)
    return F.when(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))), v)


def count_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    exact: bool = True,
    count_name: str = "n",
    sum_name: str = "total",
) -> DataFrame:
    """(keys, count of values, sum of values); partial + final aggregate."""
    return df.groupBy(*keys).agg(
        F.count(finite(value) if exact else _col(value)).alias(count_name), fixed_sum(value, exact).alias(sum_name)
    )


def hive_count_sum(joined: DataFrame, exact: bool = True) -> DataFrame:
    """Readings joined to sensors → (hive, n, total)."""
    return count_sum(joined, ["hive"], exact=exact)


def with_average(counts: DataFrame, count_name: str = "n", sum_name: str = "total") -> DataFrame:
    return counts.withColumn("average", F.col(sum_name) / F.col(count_name))


def hive_average(joined: DataFrame, exact: bool = True) -> DataFrame:
    """Readings joined to sensors → (hive, n, total, average)."""
    return with_average(hive_count_sum(joined, exact))


def report_lines(averages: DataFrame) -> DataFrame:
    """One printable line per hive: ``Average for hive <hive> = <average>``."""
    return averages.select(
        F.format_string("Average for hive %d = %s", F.col("hive"), F.col("average").cast("string")).alias(
            "line"
        )
    )
