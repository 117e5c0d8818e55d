"""Mixing sources to target weights, in packed blocks of words.

Packing: within a source, documents stand in a fixed order (a hash of the id,
then the id) and their words form one stream, cut into blocks of ``block``
words; prefix sums come from per-piece totals, so no window holds a source
whole. The words a source owes (its target) are slots, one block each; a
multinomial draw deals each source's slots to output shards. (Drawing source by
source, with the slot total fixed, is the multinomial draw of source counts
per shard conditioned on the totals; so targets are met to the word.) A slot's
number maps to a block by a pseudorandom permutation of the source's block
indices, one permutation per pass over the source; the last, shorter block
closes its pass. Slots and block segments then join on (source, block).

Targets: sources in code-point order, null last, take the weights in turn;
targets share ``ratio`` times all words by weight, none above ``most`` times
its source's words, the excess shared again by weight (the water level is
found with one sort of the source table).

Defined cases: a null text has no words and is never taken; a null source is a
source; rows that tie on id and size are interchangeable; an empty table gives
an empty result; the draw depends on ``seed``, ids, sizes and sources only, so
reruns agree whatever the partitioning; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apiary.llm.common import attach, fresh, stage, text_bytes
from apiary.llm.words import Words

WEIGHTS = (5.0, 2.0, 1.0)
RATIO = 1.5
MOST = 2
BLOCK = 64
SHARD_WORDS = 1 << 24
# Documents per piece of a source (each piece is one window of prefix sums).
PIECE = 20_000


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # bytes.split() cuts at runs of the six ASCII white-space bytes: the same words.
        sizes = [len(t.split()) if t else 0 for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_id"), batch.column("_source"), pa.array(sizes, pa.int64())],
            ["_row", "_id", "_source", "_size"],
        )


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row: Column | None = None) -> DataFrame:
    """(_row, _id, _source, _size in words), one row per document."""
    return docs.select(
        (row if row is not None else F.monotonically_increasing_id()).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        text_bytes(text_col).alias("_text"),
    ).mapInArrow(_count_words, "_row long, _id long, _source string, _size long")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, ratio: float = RATIO, most: float = MOST) -> DataFrame:
    """(_source, _sid, source_size, target): one row per source; ``_sid`` is its place in order."""
    per = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    # Windows over the source table: one row per source. Bytes of UTF-8 sort by code point.
    order = Window.orderBy(F.col("_source").cast("binary").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_sid") % len(weights) + 1).cast("int"))
    per = per.withColumn("_sid", (F.row_number().over(order) - 1).cast("long")).withColumn("_weight", weight)
    cap = F.col("source_size") * F.lit(float(most))
    by_level = Window.orderBy(cap / F.col("_weight"), "_sid")
    upto, beyond = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(ratio)))
    # The level if exactly the sources before this one are at their caps.
    level = (F.col("_all") - F.coalesce(F.sum(cap).over(upto), F.lit(0.0))) / F.sum("_weight").over(beyond)
    per = per.withColumn("_level", level)
    # The first source whose own cap is not under that level sets it; later ones only give lower levels.
    fits = F.when(F.col("_level") <= cap / F.col("_weight"), F.col("_level"))
    per = per.withColumn("_level", F.max(fits).over(everything))
    target = F.least(cap, F.coalesce(F.col("_level") * F.col("_weight"), cap))
    return per.select("_source", "_sid", "source_size", target.alias("target"))


def _seed(*parts) -> np.random.Generator:
    digest = hashlib.sha256("/".join(map(str, parts)).encode()).digest()
    return np.random.Generator(np.random.PCG64(int.from_bytes(digest[:16], "little")))


def permute(index: np.ndarray, n: int, *key) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at ``index``: four Feistel rounds on the
    next even number of bits, walked on until the result is below ``n``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _seed("permute", *key).integers(0, 1 << 63, size=4, dtype=np.uint64)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ (mixed & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _plan(size: int, target: float, block: int, most: float) -> tuple[int, int, int]:
    """(words owed, slots, blocks a pass) of a source."""
    owed = int(min(round(target), int(most * size)))
    per_pass = -(-size // block)
    passes, rest = divmod(owed, size) if size else (0, 0)
    return owed, passes * per_pass + -(-rest // block), per_pass


def _deal(seed: str, block: int, most: float, shard_words: int):
    """Per source: its slots dealt to shards; a row per shard with the range of its slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, size, target, total in zip(*(batch.column(c).to_pylist() for c in ("_sid", "source_size", "target", "_sum")), strict=True):
                owed, slots, _ = _plan(size, target, block, most)
                if not slots:
                    continue
                shards = max(1, -(-int(total) // shard_words))
                counts = _seed(seed, "shards", sid).multinomial(slots, np.full(shards, 1.0 / shards))
                begin = np.cumsum(counts) - counts
                used = np.flatnonzero(counts)
                n = len(used)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, sid), pa.int64()),
                        pa.array(np.full(n, size), pa.int64()),
                        pa.array(np.full(n, owed), pa.int64()),
                        pa.array(used, pa.int64()),
                        pa.array(begin[used], pa.int64()),
                        pa.array(counts[used], pa.int64()),
                    ],
                    ["_sid", "_size", "_owed", "shard", "_begin", "_count"],
                )

    return run


def _slots(seed: str, block: int):
    """Each slot of a range: its block by the pass's permutation, and how many of its words it takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, size, owed, shard, begin, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                full, per_pass = size // block, -(-size // block)
                for at in range(begin, begin + count, 100_000):
                    slot = np.arange(at, min(at + 100_000, begin + count))
                    turn, place = np.divmod(slot, per_pass)
                    index = np.full(len(slot), full)
                    for t in np.unique(turn).tolist():
                        inner = (turn == t) & (place < full)
                        if inner.any():
                            index[inner] = permute(place[inner], full, seed, sid, t)
                    # Words before this slot; the last slot takes only what is still owed.
                    before = turn * size + place * block
                    take = np.minimum(np.minimum(block, size - index * block), owed - before)
                    n = len(slot)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, sid), pa.int64()),
                            pa.array(index, pa.int64()),
                            pa.array(turn, pa.int32()),
                            pa.array(np.full(n, shard), pa.int64()),
                            pa.array(slot, pa.int64()),
                            pa.array(take, pa.int64()),
                        ],
                        ["_sid", "_block", "turn", "shard", "slot", "_take"],
                    )

    return run


class Mix:
    """``placed``: documents with their source's target and place in its stream;
    ``taken``: (_row, _sid, shard, slot, turn, first, words): the runs of words each slot takes."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, ratio=RATIO, most=MOST, block=BLOCK, shard_words=SHARD_WORDS, seed="mix", sized: DataFrame | None = None):
        sized = sized if sized is not None else stage(sizes(docs), "mix-sizes")
        sources = stage(source_targets(sized, weights, ratio, most), "mix-sources")
        pieces = max(1, -(-sized.count() // PIECE))
        known = sources.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("n"))).drop("_source")
        rows = attach(
            sized.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("n"))), known, ["_key"], "inner"
        ).drop("_key")
        rows = rows.withColumn("_piece", F.pmod(F.xxhash64("_id", "_size"), F.lit(pieces)))
        totals = rows.groupBy("_sid", "_piece").agg(F.sum("_size").alias("_words"))
        before = Window.partitionBy("_sid").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("_sid", "_piece", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset"))
        inside = Window.partitionBy("_sid", "_piece").orderBy(F.col("_id").asc_nulls_last(), "_size", "_row")
        upto = F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        placed = rows.withColumn("_upto", upto).join(offsets, ["_sid", "_piece"])
        self.placed = stage(
            placed.select(
                "_row", "_id", "_source", "_sid", "_size", "source_size", "target",
                (F.col("_offset") + F.col("_upto") - F.col("_size")).alias("_start"),
            ),
            "mix-placed",
        )
        whole = Window.orderBy("_sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        dealt = sources.select("_sid", "source_size", "target", F.sum("target").over(whole).alias("_sum")).mapInArrow(
            _deal(seed, block, most, shard_words), "_sid long, _size long, _owed long, shard long, _begin long, _count long"
        )
        slots = dealt.repartition("_sid", "shard").mapInArrow(
            _slots(seed, block), "_sid long, _block long, turn int, shard long, slot long, _take long"
        )
        first, last = F.expr(f"_start div {block}"), F.expr(f"(_start + _size - 1) div {block}")
        segments = (
            self.placed.where("_size > 0")
            .select("_row", "_sid", "_start", "_size", F.explode(F.sequence(first, last)).alias("_block"))
            .withColumn("_from", F.greatest(F.col("_start"), F.col("_block") * block))
            .withColumn("_until", F.least(F.col("_start") + F.col("_size"), (F.col("_block") + 1) * block))
        )
        words = F.least(F.col("_until"), F.col("_block") * block + F.col("_take")) - F.col("_from")
        # Slots are made from the few rows of the source table, whose size would suggest a broadcast.
        self.taken = segments.join(slots.hint("merge"), ["_sid", "_block"]).select(
            "_row", "_sid", "shard", "slot", "turn", (F.col("_from") - F.col("_start")).alias("first"), words.alias("words")
        ).where("words > 0")

    def blocks(self) -> DataFrame:
        """The packed blocks of every output shard: (shard, _sid, slot, words, runs), ``runs`` naming the
        documents' words in the order of the block. A shard holds as many blocks of a source as were drawn for it."""
        run = F.struct("_start", "_row", "turn", "first", "words")
        placed = self.taken.join(self.placed.select("_row", "_start"), "_row")
        return placed.groupBy("shard", "_sid", "slot").agg(
            F.sum("words").alias("words"), F.array_sort(F.collect_list(run)).alias("runs")
        )

    def per_document(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) for every document."""
        taken = self.taken.groupBy("_row").agg(F.sum("words").alias("taken"))
        return self.placed.join(taken, "_row", "left").select(
            F.col("_id").alias("doc_id"),
            F.col("_size").alias("size"),
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )


def _cut_out(schema_names: list[str], text_at: int, text_name: str, runs_name: str):
    """The taken words of a document in one turn, as its text: runs of words verbatim, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chars = [], []
            for text, runs in zip(batch.column(text_name).to_pylist(), batch.column(runs_name).to_pylist(), strict=True):
                w = Words([text])
                parts, end = [], None
                for run_ in sorted(runs, key=lambda r: r["first"]):
                    a, b = run_["first"], run_["first"] + run_["words"]
                    if a == end:
                        parts[-1] = (parts[-1][0], b)
                    else:
                        parts.append((a, b))
                    end = b
                whole = len(parts) == 1 and parts[0] == (0, len(w.start))
                out = text if whole else b"\n".join(text[w.start[a] : w.end[b - 1]] for a, b in parts)
                texts.append(out.decode("utf-8", "replace"))
                chars.append(len(texts[-1]))
            columns = {c: batch.column(c) for c in schema_names}
            columns[schema_names[text_at]] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(chars, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema_names)

    return run


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix as documents, columns as in ``docs``: one row per document and turn it is taken in,
    its text cut to the words taken (whole texts verbatim), ``n_chars`` set anew."""
    row, raw, taken = fresh("row"), fresh("text"), fresh("runs")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    sized = stage(sizes(numbered, text_col=text_col, row=F.col(row)), "mix-sizes")
    mix = Mix(docs, sized=sized, **options)
    runs = mix.taken.groupBy(F.col("_row").alias(row), F.col("turn").alias(fresh("turn"))).agg(
        F.collect_list(F.struct("first", "words")).alias(taken)
    )
    names = docs.columns
    joined = numbered.join(runs.select(row, taken), row).withColumn(raw, text_bytes(text_col))
    return joined.select(*names, raw, taken).mapInArrow(_cut_out(names, names.index(text_col), raw, taken), docs.schema)

