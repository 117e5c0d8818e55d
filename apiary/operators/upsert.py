"""Keyed upsert: the newest row per key wins, on Parquet tables.

Two ways to keep a table keyed:

* copy-on-write (``upsert_partitions``): merge a batch into the day
  partitions it touches and rewrite them; for batch loads and compaction;
* merge-on-read (``append_batch`` + ``read_latest`` + ``compact_batches``):
  each micro-batch writes only its own ``day/batch`` folders, readers keep
  the newest row per key, and batches are merged into a table of their own
  later. A 1-second stream then writes O(batch), never O(day).

``latest_per_key`` keeps, for each key, the row with the greatest ordering
value. It is one aggregate with ``max_by``: rows are combined map-side
before the shuffle, so a key holding a large share of all rows still sends
one row per task, never its whole group. The ordering must come from the
data (an event id, a source offset, a batch id and position), so a replay
picks the same winners.

``upsert_partitions`` merges a batch into a table partitioned by day: read
the partitions the batch touches, union, keep the newest per key, stage the
result as a written table under the shared work folder, then overwrite only
those partitions (dynamic partition overwrite). Staging cuts the lineage, so
the overwrite never reads what it is replacing, and a lost executor only
costs a recompute from durable files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.session import work_path

# Partition column of the compacted table: one value per merge, never reused.
GENERATION = "_generation"

# Most partition values a batch may touch for the literal-list pruning path.
MAX_TOUCHED_PARTITIONS = 10_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` tuple."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # A dynamic partition overwrite leaves no _SUCCESS marker at the root,
    # so the table exists when its folder holds any partition or file.
    return fs.exists(hpath) and len(fs.listStatus(hpath)) > 0


def upsert_partitions(
    batch: DataFrame,
    table_path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_col: str = "bucket_date",
) -> str | None:
    """Merge ``batch`` into the table at ``table_path`` (newest per key wins).

    Returns the staging folder of the merge (None for a first load, which is
    written directly); see :func:`overwrite_from_stage`.
    """
    spark = batch.sparkSession
    if table_exists(spark, table_path):
        table = spark.read.schema(batch.schema).parquet(table_path)
        touched = batch.select(partition_col).distinct()
        # The touched days are a short list (one value per calendar day); one
        # bounded job fetches it, and as literals it prunes the table's
        # folders statically (a semi-join would get no dynamic pruning here
        # and read every day).
        values = [r[0] for r in touched.limit(MAX_TOUCHED_PARTITIONS + 1).collect()]
        if len(values) <= MAX_TOUCHED_PARTITIONS:
            known = [v for v in values if v is not None]
            # `in` never matches a null partition, which the overwrite replaces as well.
            null_too = F.col(partition_col).isNull() if None in values else F.lit(False)
            existing = table.where(F.col(partition_col).isin(known) | null_too)
        else:
            days = touched.withColumnRenamed(partition_col, "_day")
            existing = table.join(days, F.col(partition_col).eqNullSafe(F.col("_day")), "left_semi")
        merged = latest_per_key(existing.unionByName(batch), keys, order_by)
    else:
        # Nothing is read from the target: write it directly.
        merged = latest_per_key(batch, keys, order_by)
        (
            merged.hint("rebalance", partition_col)
            .select(*batch.columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_col)
            .parquet(table_path)
        )
        return None
    stage = work_path(spark, "staging")
    # Rebalance by day before the partitioned write: few files per day, and
    # adaptive execution splits a day holding a large share of the rows.
    merged.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(stage)
    overwrite_from_stage(spark, stage, table_path, batch.schema, partition_col)
    return stage


def overwrite_from_stage(
    spark: SparkSession, stage: str, table_path: str, schema, partition_col: str = "bucket_date"
) -> None:
    """Replace the table's partitions present in ``stage`` by the staged ones.

    The last step of :func:`upsert_partitions`. The staged merge is durable,
    so if a job dies while this overwrite commits, calling this again with
    the same stage restores every touched partition.
    """
    staged = spark.read.schema(schema).parquet(stage)
    (
        staged.select(*schema.fieldNames())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(table_path)
    )


def read_table(spark: SparkSession, table_path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(table_path)


def append_batch(
    batch: DataFrame, table_path: str, partition_col: str = "bucket_date", batch_col: str = "batch_id"
) -> None:
    """Write one batch into its own (day, batch) folders.

    Dynamic partition overwrite replaces exactly the folders of this batch,
    so a replayed batch rewrites its own output and adds nothing.
    """
    (
        batch.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col, batch_col)
        .parquet(table_path)
    )


def read_all(spark: SparkSession, table_path: str, schema) -> DataFrame:
    """Every stored row of a merge-on-read table: its batches and its merged rows."""
    # The batches are listed first: one that is gone by then is in the merged rows listed next.
    df = spark.read.schema(schema).parquet(table_path).select(*schema.fieldNames())
    merged = compacted_path(table_path)
    if not table_exists(spark, merged):
        return df
    return df.unionByName(spark.read.schema(_merged_schema(schema)).parquet(merged).drop(GENERATION))


def read_latest(
    spark: SparkSession,
    table_path: str,
    schema,
    keys: Sequence[str],
    order_by: Sequence[str],
    where=None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Merge-on-read view: newest row per key (optionally of some days only).

    A filter on key columns alone is applied before the newest row is picked
    (it prunes the scan); any other filter sees only the newest rows. With
    ``columns``, only these, the keys and the order are read and returned.
    """
    df = read_all(spark, table_path, schema)
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, *order_by, *columns]))
    if where is None:
        return latest_per_key(df, keys, order_by)
    try:
        # An empty table of the keys: does the filter need any other column?
        spark.createDataFrame([], df.select(*keys).schema).where(where)
    except AnalysisException:
        return latest_per_key(df, keys, order_by).where(where)
    return latest_per_key(df.where(where), keys, order_by)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def compacted_path(table_path: str) -> str:
    """The folder beside a merge-on-read table that holds its merged rows."""
    return table_path.rstrip("/") + "_compacted"


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """Id of the last batch a stream has committed to ``checkpoint`` (-1: none)."""
    jvm, root, fs = _fs(spark, checkpoint)
    commits = jvm.org.apache.hadoop.fs.Path(root, "commits")
    if not fs.exists(commits):
        return -1
    names = [st.getPath().getName() for st in fs.listStatus(commits)]
    return max([int(n) for n in names if n.isdigit()], default=-1)


def list_partitions(spark: SparkSession, table_path: str, partition_col: str = "bucket_date") -> list[str]:
    """Values of the top-level partition folders (one per day: a short list)."""
    _, root, fs = _fs(spark, table_path)
    if not fs.exists(root):
        return []
    prefix = partition_col + "="
    return sorted(
        st.getPath().getName()[len(prefix):]
        for st in fs.listStatus(root)
        if st.isDirectory() and st.getPath().getName().startswith(prefix)
    )


def _folders(spark: SparkSession, path: str, day: str | None, partition_col: str | None, level: str) -> dict:
    """Value → path of the ``level=…`` folders of one day (``day=None``: of a table without days)."""
    jvm, root, fs = _fs(spark, path)
    at = root if day is None else jvm.org.apache.hadoop.fs.Path(root, f"{partition_col}={day}")
    if not fs.exists(at):
        return {}
    found = [st.getPath() for st in fs.listStatus(at) if st.isDirectory()]
    return {p.getName()[len(level) + 1 :]: p for p in found if p.getName().startswith(level + "=")}


def compact_batches(
    spark: SparkSession,
    table_path: str,
    schema,
    keys: Sequence[str],
    order_by: Sequence[str],
    days: Sequence[str | None],
    upto_batch: int | None = None,
    partition_col: str | None = "bucket_date",
    batch_col: str = "batch_id",
) -> int:
    """Merge the batch folders of ``days`` into the compacted table beside the table.

    Batches up to ``upto_batch`` are merged; it must be committed (see
    :func:`last_committed`) while the stream runs, and None takes every batch,
    for a stream that has stopped. Later batches may arrive meanwhile, for the
    same days too: 1. the folders are listed; 2. exactly those, and the days'
    earlier merges, are read, and the newest row per key is written as a new
    generation that no batch ever overwrites; 3. exactly the listed folders
    are dropped. Rows keep their own batch id and position, and readers take
    the newest row per key of both tables, so a crash between the steps, a
    late batch or a replayed one adds repeated rows at worst and loses none.
    ``days`` are folder values (the null day's as well); ``[None]`` is a table
    without a day level. Returns the number of batch folders merged away.
    """
    merged_path = compacted_path(table_path)
    batches, merges = [], []
    for day in days:
        found = _folders(spark, table_path, day, partition_col, batch_col)
        now = [p for b, p in found.items() if upto_batch is None or int(b) <= upto_batch]
        if now:
            batches += now
            merges += _folders(spark, merged_path, day, partition_col, GENERATION).values()
    if not batches:
        return 0
    rows = _read_folders(spark, table_path, schema, batches)
    if merges:
        rows = rows.unionByName(_read_folders(spark, merged_path, _merged_schema(schema), merges).drop(GENERATION))
    latest = latest_per_key(rows, keys, order_by).withColumn(GENERATION, F.lit(uuid.uuid4().hex))
    by = [partition_col] if partition_col else []
    if by:
        latest = latest.hint("rebalance", partition_col)
    latest.write.mode("append").partitionBy(*by, GENERATION).parquet(merged_path)
    _, _, fs = _fs(spark, table_path)
    for folder in merges + batches:
        fs.delete(folder, True)
    return len(batches)


def _merged_schema(schema) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(GENERATION, T.StringType())])


def _read_folders(spark: SparkSession, base: str, schema, folders) -> DataFrame:
    paths = [p.toString() for p in folders]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())
