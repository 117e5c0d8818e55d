"""Spark session settings the library relies on, and the shared work folder.

Everything here is plain Spark configuration:

* session time zone UTC, so calendar functions agree with the stored
  instants (readings are UTC instants);
* adaptive query execution with partition coalescing and skew-join
  splitting, so shuffle sizes follow the data at run time;
* dynamic partition overwrite, so an upsert rewrites only the day
  partitions it touches.

Durable intermediate data (staged upserts, stream checkpoints, feeds written
by the test catalogue) goes below the folder named by ``spark.checkpoint.dir``.
On a cluster that setting points at shared storage and is read, never
replaced; only when it is unset (local tests) is a local folder chosen.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Sizing for a large cluster reading tens of terabytes.

    * scan splits of 256 MB: a 100 TB scan is ~400k tasks, each well inside
      an executor's memory, instead of ~800k tasks of scheduling overhead;
    * shuffles start at 4 partitions per core and adaptive execution merges
      them towards 256 MB each, so small stages do not run thousands of
      empty tasks and large ones do not spill;
    * a shuffle partition counts as skewed above 5× the median and 512 MB,
      and is then split (joins) or rebalanced (writes).
    """
    return {
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(4 * total_cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(4 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def build_session(
    master: str | None = None,
    app_name: str = "apiary",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    cluster_cores: int | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library's settings applied.

    ``cluster_cores`` (total executor cores) adds :func:`cluster_conf`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in (cluster_conf(cluster_cores) if cluster_cores else {}).items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


_LOCAL_ROOTS: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Shared folder for durable intermediate data.

    Uses ``spark.checkpoint.dir`` when the cluster names one. When it is
    unset (local runs and tests) a local folder is created once per
    application, and used as the RDD checkpoint folder as well. On a cluster
    an unset folder is an error: a machine-local one would be seen by one
    machine only.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="apiary-work-")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(os.path.join(_LOCAL_ROOTS[app], "rdd-checkpoints"))
    return _LOCAL_ROOTS[app]


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared work folder (never reused)."""
    return os.path.join(work_root(spark), *parts, uuid.uuid4().hex)
