"""Sharding: contiguous shards of nearly equal byte size.

Order: ascending id (null first). Rows are range-partitioned by the order,
each partition's total size is summed, and the running sum of the totals gives
every partition its global offset; inside a partition a window gives each row
its prefix sum. Row ``r`` with ``b`` bytes before it goes to shard
``floor(b * shards / total)``: cuts at equal targets, so shards are contiguous
and differ from the target by less than the largest row. Only (id, size,
checksum) travel, and no window spans more than one range partition.

DataFrame functions only.

Defined cases: a null text has no bytes (size 1, checksum 0 of the empty
string); rows that tie on id are ordered by size, checksum and input position;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apiary.llm.common import attach, stage, text_bytes, width


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, first_byte) for every row of ``docs``."""
    spark = docs.sparkSession
    content = F.coalesce(text_bytes(text_col), F.lit(b""))
    rows = stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(content) + F.lit(1)).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-sizes",
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("_row")]
    ranged = stage(
        rows.repartitionByRange(width(spark), *order).withColumn("_part", F.spark_partition_id()), "shard-ranges"
    )
    # One row per range partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        F.sum("_bytes").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = attach(ranged, offsets, ["_part"], "inner").select(
        "doc_id",
        "size",
        "text_crc32",
        "_total",
        (F.col("_byte0") + upto - F.col("size")).alias("first_byte"),
        (F.col("_row0") + F.row_number().over(inside) - F.lit(1)).alias("_index"),
    )
    placed = placed.withColumn("shard", F.expr(f"cast(first_byte * {int(shards)} div _total as int)"))
    # At most `shards` rows.
    firsts = placed.groupBy("shard").agg(F.min("_index").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot"), "first_byte"
    )
