"""Helpers shared by the operators: reading, staging, small-side joins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apiary.session import work_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Largest side, in rows, that `attach` broadcasts; its rows are a few numbers wide.
BROADCAST_ROWS = 20_000


def small_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of a few MB, so a worker's memory stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null stays null."""
    return F.col(column).cast("string").cast("binary")


def ascii_lower(column: str = "text") -> Column:
    """Lower-case A-Z only; null counts as empty. Pure ASCII takes the fast built-in."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared work folder and read it back.

    This fixes the rows (ids drawn while writing stay the same for every later
    reader), cuts the lineage, and survives the loss of executors.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = work_path(spark, f"llm-{name}")
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    schema = df.schema
    if partition_by:
        fields = [f for f in schema.fields if f.name != partition_by]
        schema = type(schema)(fields + [schema[partition_by]])
    return spark.read.schema(schema).parquet(path)


def attach(large: DataFrame, small: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a side of a few rows: broadcast if at most ``rows`` rows were counted,
    else a shuffle join, whose skewed partitions adaptive execution splits."""
    if small.limit(rows + 1).count() <= rows:
        small = F.broadcast(small)
    return large.join(small, on, how)


def width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh(name: str) -> str:
    """A column name no table carries."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def join_groups(rows: DataFrame, groups: DataFrame, key: list[str], size_col: str, total: int, hot: int = 1000) -> DataFrame:
    """Left join of rows with their groups (one row per key; ``size_col``: its rows among ``total``).

    Groups beyond 1/``hot`` of all rows number under ``hot``, whatever the input:
    they are broadcast. The shuffle join of the rest has no hot key.
    """
    large = F.col(size_col) * hot > F.lit(total)
    columns = [c for c in groups.columns if c not in key]
    found = rows.join(F.broadcast(groups.where(large)), key, "left")
    rest = found.where(F.col(size_col).isNull()).drop(*columns).join(groups.where(~large), key, "left")
    return found.where(F.col(size_col).isNotNull()).unionByName(rest)
