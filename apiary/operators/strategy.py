"""Join strategy helpers: broadcast only behind a proven size bound.

``bounded(df, max_rows)`` runs ``df.limit(max_rows + 1).count()``: the job
stops reading once ``max_rows + 1`` rows are seen, so the check itself is
bounded whatever the input size. A side that passes is broadcast; one that
does not is joined by shuffle, where adaptive execution splits skewed
partitions, and where a caller may also salt the large side's hot keys. The
shuffle is asked for by name (a merge join): Spark's own estimate takes a side
for as large as its files, whatever ``explode`` makes of it, and would
broadcast a side that has just failed the check.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side, in rows, that is broadcast (about 100 bytes a row keeps the
# broadcast under ~50 MB). Tunable per call.
DEFAULT_BROADCAST_ROWS = 500_000

# Most keys whose rows are salted: those with the most rows.
HOT_KEYS = 1_000


def bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (bounded-cost check)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    salt_buckets: int = 1,
) -> DataFrame:
    """Join a large side with a side expected to be small.

    The small side is broadcast when it holds at most ``max_rows`` rows.
    Otherwise both sides shuffle on the key and merge; with ``salt_buckets > 1``
    the rows of the large side's ``HOT_KEYS`` commonest keys are spread over
    that many salts, and the small side's rows of these keys, and no others,
    are replicated once per salt, so one hot key is split over many tasks
    (inner and left joins with ``on`` given as column names only). A stream's
    keys cannot be counted beforehand, and keys of two types are equal by a
    cast only: neither is salted.
    """
    if bounded(small, max_rows):
        return large.join(F.broadcast(small), on, how)
    if salt_buckets <= 1 or isinstance(on, Column):
        return large.join(small.hint("merge"), on, how)
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError("salting supports inner and left joins only")
    keys = [on] if isinstance(on, str) else list(on)
    if large.isStreaming or any(large.schema[k].dataType != small.schema[k].dataType for k in keys):
        return large.join(small.hint("merge"), keys, how)
    hot = F.broadcast(hot_keys(large, keys).withColumn("_hot", F.lit(True)))
    # A null key meets nothing, so its rows may go anywhere.
    many = F.col("_hot").isNotNull() | reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in large.columns]), F.lit(salt_buckets))
    salted_large = large.join(hot, keys, "left").withColumn("_salt", F.when(many, salt).otherwise(F.lit(0)))
    salted_small = replicated(small, hot, keys, salt_buckets).hint("merge")
    return salted_large.drop("_hot").join(salted_small, keys + ["_salt"], how).drop("_salt")


def replicated(small: DataFrame, hot: DataFrame, keys: Sequence[str], salt_buckets: int) -> DataFrame:
    """``small`` with ``_salt``: each row of a hot key once per salt, each other row once."""
    last = F.when(F.col("_hot").isNotNull(), F.lit(salt_buckets - 1)).otherwise(F.lit(0))
    salts = F.explode(F.sequence(F.lit(0), last).cast("array<bigint>"))
    return small.join(hot, list(keys), "left").withColumn("_salt", salts).drop("_hot")


def hot_keys(df: DataFrame, keys: Sequence[str], most: int = HOT_KEYS) -> DataFrame:
    """The ``most`` commonest values of ``keys`` in ``df``: a list of bounded length, fixed by one job.

    The list is fetched, so that both sides of a join salt the same keys.
    """
    counts = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.orderBy(F.desc("_n")).limit(most).select(*keys).collect()
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], T.StructType([df.schema[k] for k in keys]))


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Spread a narrow input over all task slots before heavy per-row work.

    When ``df`` is too small to give every task slot a split (by the plan's
    estimated bytes; nothing is run), it is hash-partitioned over that
    many partitions (by ``cols``, else by a hash of the whole row), so
    parsing and encoding run on every core. An input that already has
    enough partitions, as any large scan does, is returned unchanged: no
    shuffle is added at scale. Streaming inputs are left as they are.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    # Splits the scan would give, from the plan's estimated bytes: no job runs while a query is built.
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if size >= target * split:
        return df
    keys = [F.col(c) for c in cols] or [F.xxhash64(*[F.col(c) for c in df.columns])]
    return df.repartition(target, *keys)
