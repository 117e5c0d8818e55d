"""Message sources and sinks: JSON text lines, from files or a Kafka topic.

Every reader returns ``(key STRING, value STRING, source_pos STRUCT)``; the key
is optional metadata (the message key of a topic, null for files) and never
required. ``source_pos`` is the place of the message in its source, and orders
messages the same way in every run:

* topic: topic, partition and offset (messages of one key share a partition);
* files: the file's modification time and path, the start of the block the row
  was read from, and the row's place in that block. Rows of one block keep their
  order and blocks are compared by their start, so cutting files into other
  splits, or reading them with other cores, changes no comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apiary.schemas import SOURCE_POS


def _from_files(lines: DataFrame) -> DataFrame:
    pos = F.struct(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        # A stream numbers the rows of a block when it works on a micro-batch (`ingest.message_columns`).
        (F.lit(None).cast("long") if lines.isStreaming else F.monotonically_increasing_id()).alias("row"),
    )
    return lines.select(F.lit(None).cast("string").alias("key"), "value", pos.cast(SOURCE_POS).alias("source_pos"))


def _from_topic(records: DataFrame) -> DataFrame:
    pos = F.struct(
        F.lit(None).cast("timestamp").alias("at"),
        F.col("topic").alias("name"),
        F.col("partition").cast("long").alias("block"),
        F.col("offset").cast("long").alias("row"),
    )
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        pos.cast(SOURCE_POS).alias("source_pos"),
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of JSON-lines files: one message per line."""
    return _from_files(spark.read.text(path))


def message_stream(
    spark: SparkSession,
    kind: str = "text",
    path: str | None = None,
    topic: str | None = None,
    bootstrap_servers: str | None = None,
    starting_offsets: str = "latest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of raw messages from a topic or a folder of files.

    The topic form reads from the latest offsets by default; offsets are kept
    in the query's checkpoint, so a restart resumes where it stopped.
    ``max_offsets_per_trigger`` / ``max_files_per_trigger`` bound a
    micro-batch (back-pressure); ``min_partitions`` spreads a topic with few
    partitions over more tasks.
    """
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        if min_partitions:
            # Split large topic partitions over more tasks (parsing is CPU work).
            reader = reader.option("minPartitions", str(min_partitions))
        return _from_topic(reader.load())
    if kind != "text":
        raise ValueError(f"unknown source kind {kind!r}")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _from_files(reader.load(path))


def start_write_messages(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Publish a stream's ``value`` strings to text files, exactly once.

    The file sink's commit log names the files of finished micro-batches;
    :func:`read_messages` of the same folder reads those and no others.
    """
    return (
        messages.select("value")
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def write_messages(
    messages: DataFrame,
    kind: str = "text",
    path: str | None = None,
    topic: str | None = None,
    bootstrap_servers: str | None = None,
    mode: str = "append",
) -> None:
    """Publish ``value`` strings (and ``key`` when present) to files or a topic."""
    if kind == "kafka":
        cols = [c for c in ("key", "value") if c in messages.columns]
        (
            messages.select(*cols)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic)
            .save()
        )
        return
    if kind != "text":
        raise ValueError(f"unknown sink kind {kind!r}")
    messages.select("value").write.mode(mode).text(path)
