"""Exact dedup: tree merge of sorted digest runs.

Each partition holds a run of (digest, best row, number of rows). In every
round, groups of ``FANIN`` partitions (2**3: three binomial steps at once)
exchange parts of their runs: digit r of the receiving partition's number is
set to digit r of the digest, the other digits stay. The receiver sorts what
it got (an external merge that spills) and folds equal neighbours into one
row, keeping the best id, so a group of copies shrinks to one row per
partition before it travels further and never gathers in one task. After the
last round a partition's number spells the digest's leading digits: each
digest is left in one row. Only digests travel, never texts.

"Equal" is verified at every fold on the whole key: SHA-256 of the
normalised text together with its length in bytes.

Defined cases: a null text counts as empty; a null id ranks below every other;
of rows that tie on id, one row stays (any one: they are equal in both); an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apiary.llm.common import fresh, join_groups, stage, text_bytes, width

FANIN_BITS = 3
FANIN = 1 << FANIN_BITS

_DIGESTS = "_row long, _id long, _sha binary, _bytes long"
_RUN = "_at int, _sha binary, _bytes long, _best long, _row long, _n long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or b"").lower() for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_row"),
                batch.column("_id"),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["_row", "_id", "_sha", "_bytes"],
        )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """One row per document: row number, id, SHA-256 of the text with A-Z lower-cased, its bytes."""
    rows = docs.select(
        (row if row is not None else F.monotonically_increasing_id()).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        text_bytes(text_col).alias("_text"),
    )
    return rows.mapInArrow(_digest, _DIGESTS)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold equal neighbours of a sorted run; the best row of each comes first."""
    held = None
    names: list[str] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        run = pa.Table.from_batches([batch])
        if held is not None:
            run = pa.concat_tables([held, run.cast(held.schema)])
        folded = (
            run.group_by(["_at", "_sha", "_bytes"], use_threads=False)
            .aggregate([("_best", "first"), ("_row", "first"), ("_n", "sum")])
            .rename_columns(["_at", "_sha", "_bytes", "_best", "_row", "_n"])
            .select(names)
            .cast(run.schema)
        )
        # The last key may go on in the next batch.
        held = folded.slice(folded.num_rows - 1)
        yield from folded.slice(0, folded.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def _digit(sha: str, r: int) -> Column:
    """Digit ``r`` (three bits) of the digest; ten digits fit in its first 32 bits."""
    head = F.conv(F.substring(F.hex(F.col(sha)), 1, 8), 16, 10).cast("long")
    return F.shiftright(head, 32 - FANIN_BITS * (r + 1)).bitwiseAND(F.lit(FANIN - 1)).cast("int")


def merge_runs(rows: DataFrame, keep: str = "smallest", rounds: int | None = None) -> DataFrame:
    """(_sha, _bytes, _best, _row, _n): per distinct text the id that stays and the group's size.

    ``rows``: the staged result of :func:`digests`. ``keep``: ``smallest`` or
    ``largest`` id. The number of leaf runs follows the shuffle width.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    spark = rows.sparkSession
    if rounds is None:
        rounds = 1
        while FANIN**rounds < width(spark) and rounds < 8:
            rounds += 1
    parts = FANIN**rounds
    best = F.col("_best").asc_nulls_last() if keep == "smallest" else F.col("_best").desc_nulls_last()
    run = rows.select(
        F.pmod(F.spark_partition_id(), F.lit(parts)).cast("int").alias("_at"),
        "_sha",
        "_bytes",
        F.col("_id").alias("_best"),
        "_row",
        F.lit(1).cast("long").alias("_n"),
    )
    order = [F.col("_at"), F.col("_sha"), F.col("_bytes"), best, F.col("_row")]
    run = run.sortWithinPartitions(*order).mapInArrow(_fold, _RUN)
    for r in range(rounds):
        place = FANIN ** (rounds - 1 - r)
        old = F.floor(F.col("_at") / F.lit(place)).cast("int") % F.lit(FANIN)
        run = run.withColumn("_at", (F.col("_at") + (_digit("_sha", r) - old) * F.lit(place)).cast("int"))
        run = run.repartitionById(parts, F.col("_at")).sortWithinPartitions(*order).mapInArrow(_fold, _RUN)
    return run.drop("_at")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", rows: DataFrame | None = None
) -> DataFrame:
    """(_row, _id, _sha, keep_id, group_size, kept) for every row of ``docs``."""
    rows = rows if rows is not None else stage(digests(docs, id_col, text_col), "digests")
    groups = stage(
        merge_runs(rows, keep).select(
            "_sha", "_bytes", F.col("_best").alias("keep_id"), F.col("_row").alias("_keep_row"), F.col("_n").alias("group_size")
        ),
        "digest-groups",
    )
    out = join_groups(rows, groups, ["_sha", "_bytes"], "group_size", rows.count())
    return out.select("_row", "_id", "_sha", "keep_id", "group_size", (F.col("_row") == F.col("_keep_row")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    row = fresh("row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-docs")
    rows = digests(numbered, id_col, text_col, F.col(row))
    stays = exact_dedup(docs, id_col, text_col, keep, stage(rows, "digests")).where("kept")
    return numbered.join(stays.select(F.col("_row").alias(row)), row, "left_semi").drop(row)
