"""Range lookup: map a number to the entry of a cumulative bounds table.

The bounds table has one row per entry with an upper bound ``hi``; entry i
covers the interval (hi of entry i-1, hi of entry i], the first entry covers
everything up to its ``hi``. A number above the last bound, or not a number,
maps to a default (``All Other``).

Instead of testing every bound for every row (a nested-loop join), both
sides are cut into ``bins`` equal bins over [0, 1]: each bound row is
replicated to the bins its interval overlaps, and each probe row equi-joins
on its own bin, then keeps the one entry whose interval holds it. The probe
side never shuffles when the binned bounds are broadcast, and each probe row
meets only the few entries of its bin.

The lower end of each interval is found without a global sort: the
previous bound inside the same bin (window per bin), else the largest bound
of the earlier bins (a running max over the per-bin maxima, at most
``bins + 1`` rows).

:func:`range_lookup_sorted` does the same for bounds of any number, by a merge
of both sides over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apiary.operators.strategy import DEFAULT_BROADCAST_ROWS, bounded, join_small
from apiary.session import work_path

DEFAULT_BINS = 1024
DEFAULT_NAME = "All Other"


def _bin(x: Column, bins: int) -> Column:
    # Clamp to [0, bins] so values below 0 meet the first entry and values
    # above 1 meet nothing.
    return F.least(F.greatest(F.floor(x * bins), F.lit(0)), F.lit(bins + 1)).cast("long")


def binned_bounds(bounds: DataFrame, bins: int = DEFAULT_BINS, hi: str = "hi") -> DataFrame:
    """Bounds with ``lo`` (exclusive, null for the first) and one row per bin."""
    b = bounds.withColumn("_hbin", _bin(F.col(hi), bins))
    b = b.withColumn("_lo_in", F.lag(hi).over(Window.partitionBy("_hbin").orderBy(hi)))
    per_bin = b.groupBy("_hbin").agg(F.max(hi).alias("_bin_max"))
    earlier = Window.orderBy("_hbin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.select("_hbin", F.max("_bin_max").over(earlier).alias("_lo_prev"))
    b = join_small(b, per_bin, "_hbin", "left")
    b = b.withColumn("lo", F.coalesce(F.col("_lo_in"), F.col("_lo_prev")))
    first_bin = F.when(F.col("lo").isNull(), F.lit(0)).otherwise(_bin(F.col("lo"), bins))
    return b.select(
        F.explode(F.sequence(first_bin, F.col("_hbin"))).alias("_bin"),
        "lo",
        *[c for c in bounds.columns],
    )


def range_lookup(
    df: DataFrame,
    u: Column | str,
    bounds: DataFrame,
    names: Sequence[str] = ("name",),
    default: str = DEFAULT_NAME,
    bins: int = DEFAULT_BINS,
    hi: str = "hi",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``df`` plus the ``names`` columns of the entry holding ``u``.

    The first name column falls back to ``default`` when no entry holds
    ``u``; the others stay null. Bounds beyond ``max_broadcast_rows`` are
    not binned: both sides are merged instead (:func:`range_lookup_sorted`).
    """
    if not bounded(bounds, max_broadcast_rows):
        return range_lookup_sorted(df, u, bounds, names, default, hi)
    ucol = F.col(u) if isinstance(u, str) else u
    probe = df.withColumn("_u", ucol.cast("double")).withColumn("_bin", _bin(F.col("_u"), bins))
    table = binned_bounds(bounds.select(hi, *names), bins, hi).select(
        F.col("_bin").alias("_tbin"), F.col("lo").alias("_lo"), F.col(hi).alias("_hi"), *names
    )
    # The interval test is part of the join condition: a probe row whose bin
    # holds no matching entry stays, with null names (left join).
    inside = (F.col("_lo").isNull() | (F.col("_u") > F.col("_lo"))) & (F.col("_u") <= F.col("_hi"))
    on = (F.col("_bin") == F.col("_tbin")) & inside
    # A row per bound and bin it begins: at most the checked number and the bins.
    joined = probe.join(F.broadcast(table), on, "left")
    return joined.drop("_bin", "_tbin", "_lo", "_hi", "_u").withColumn(
        names[0], F.coalesce(F.col(names[0]), F.lit(default))
    )


def range_lookup_sorted(
    df: DataFrame,
    u: Column | str,
    bounds: DataFrame,
    names: Sequence[str] = ("name",),
    default: str = DEFAULT_NAME,
    hi: str = "hi",
    parts: int | None = None,
) -> DataFrame:
    """:func:`range_lookup` for bounds of any number: a merge of two sorted sides.

    Numbers and bounds go together into ranges of nearly equal size
    (``repartitionByRange``; rows of one number are dealt on by a hash of the
    whole row, so a hot number or a hot interval is cut as well). Inside a range
    the entry of a number is the nearest bound at or above it: the ``last`` bound
    met from above. A range's highest numbers may have no such bound in it; they
    take the lowest bound of the ranges above, one carried row per range. Nothing
    is broadcast but that list, and no number is compared with more than one bound.

    Numbers may repeat, be null or NaN (null or the default name, as in
    :func:`range_lookup`); of equal bounds the one with the smallest names counts.
    """
    spark = df.sparkSession
    ucol = (F.col(u) if isinstance(u, str) else u).cast("double")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    carried = F.struct(F.col(hi).cast("double").alias("hi"), *names)
    # A number has row, a bound has entry. Equal numbers: the bound comes first from above.
    numbers = df.select(
        ucol.alias("_at"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
        F.xxhash64(*[F.col(c) for c in df.columns]).alias("_salt"),
    )
    entries = (
        bounds.where(F.col(hi).isNotNull() & ~F.isnan(F.col(hi).cast("double")))
        .groupBy(F.col(hi).cast("double").alias("_at"))
        .agg(F.min(carried).alias("_entry"))
        .withColumn("_salt", F.lit(2**63 - 1))
    )
    merged = numbers.unionByName(entries, allowMissingColumns=True)
    path = work_path(spark, "range-lookup")
    # Written once: a range number must mean the same rows to every later reader.
    merged.repartitionByRange(parts, F.asc_nulls_first("_at"), "_salt").withColumn(
        "_part", F.spark_partition_id()
    ).write.parquet(path)
    ranged = spark.read.schema(merged.withColumn("_part", F.lit(0)).schema).parquet(path)
    # One row per range: its lowest bound, then the lowest bound of all ranges above.
    lowest = ranged.groupBy("_part").agg(F.min("_entry").alias("_lowest"))
    above = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carry = lowest.select("_part", F.last("_lowest", ignorenulls=True).over(above).alias("_carry"))
    down = (
        Window.partitionBy("_part")
        .orderBy(F.desc_nulls_last("_at"), F.desc("_salt"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    met = ranged.withColumn("_met", F.last("_entry", ignorenulls=True).over(down)).where("_row IS NOT NULL")
    found = met.join(F.broadcast(carry), "_part", "left").withColumn(
        "_found", F.when(F.col("_at").isNotNull() & ~F.isnan("_at"), F.coalesce("_met", "_carry"))
    )
    out = found.select("_row.*", *[F.col(f"_found.{n}").alias(n) for n in names])
    return out.withColumn(names[0], F.coalesce(F.col(names[0]), F.lit(default)))
