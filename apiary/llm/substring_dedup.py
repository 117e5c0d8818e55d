"""Substring dedup: repeated windows of ``WINDOW`` words become removal intervals.

Every window of 50 consecutive words has a Rabin-Karp hash. Windows are counted
in Spark by hash, with the smallest id they start in; a window is removed from a
document if a smaller id has it too. Overlapping removed windows merge into
maximal intervals of words.

Only windows that can repeat are sent to the count. Two equal windows hold the
same words, so they hold the same anchor: the smallest of the hashes of their
26 sub-windows of 25 words. One row per distinct anchor and document (about a
thirteenth of the windows) tells which anchors occur in two documents; windows
whose anchor does not cannot repeat. This leaves nothing out. The counting
aggregates combine before the shuffle, so a passage that a third of all
documents share is folded inside each task; the joins back have one row per
hash on one side, and adaptive execution splits their hot partitions. Rows are
staged under a row number, and the lists of anchors and windows are kept by it,
so a list is bounded by its own text however many rows share an id; ids only
decide which window stays.

Defined cases: a null text has no words; a text under 50 words keeps all; a
null id ranks above every other; rows that share an id are one document as
far as counting goes, each with its own result; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.llm.common import stage, text_bytes
from apiary.llm.words import BASE_WINDOW_A, BASE_WORD, Words, batches_of_bytes, mix, run_hashes

WINDOW = 50
LAST = (1 << 63) - 1


def _sliding(values: np.ndarray, n: int, op) -> np.ndarray:
    """``op`` over each run of ``n`` values: runs of doubling length, then two that overlap."""
    out, done = values, 1
    while 2 * done <= n:
        out = op(out[:-done], out[done:])
        done *= 2
    rest = n - done
    return op(out[: len(out) - rest], out[rest:]) if rest else out


class Windows:
    """Windows of a batch: ``doc`` (text number), ``at`` (first word) and ``anchor`` of each."""

    def __init__(self, texts, window: int):
        w = self.words = Words(texts)
        self.window = window
        h = self._h = w.hashes()
        doc = np.repeat(np.arange(len(texts)), np.diff(w.first))
        n = len(h)
        if n < window:
            self.at = self.doc = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        sub = max(1, window // 2)
        starts = np.arange(n - sub + 1)
        subs = mix(run_hashes(h, starts, starts + sub, BASE_WORD))
        anchors = _sliding(subs, window - sub + 1, np.minimum)
        inside = doc[: n - window + 1] == doc[window - 1 :]
        self.at = np.flatnonzero(inside)
        self.doc = doc[self.at]
        self.anchor = anchors[self.at]

    def hashes(self, chosen: np.ndarray) -> np.ndarray:
        at = self.at[chosen]
        return mix(run_hashes(self._h, at, at + self.window, BASE_WINDOW_A))


def _scan(window: int):
    """Per document: packed text, number of words and digest of all words; per distinct anchor: a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_row", "_id", "_hash", "_words", "_sha", "_packed", "_kind"]
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            numbers = batch.column("_row").to_numpy(zero_copy_only=False)
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            for a, b in batches_of_bytes(texts):
                v = Windows(texts[a:b], window)
                shas = [hashlib.sha256(b" ".join(t.split() if t else [])).hexdigest() for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers[a:b], pa.int64()),
                        pa.array(ids[a:b], pa.int64()),
                        pa.nulls(b - a, pa.int64()),
                        pa.array(np.diff(v.words.first), pa.int64()),
                        pa.array(shas, pa.string()),
                        pa.array([squeeze(t or b"") for t in texts[a:b]], pa.binary()),
                        pa.array(["doc"] * (b - a), pa.string()),
                    ],
                    names,
                )
                # Neighbouring windows mostly share their anchor; a sort folds the rest.
                new = np.ones(len(v.at), dtype=bool)
                new[1:] = (v.anchor[1:] != v.anchor[:-1]) | (v.doc[1:] != v.doc[:-1])
                doc, anchor = v.doc[new], v.anchor[new]
                order = np.lexsort((anchor, doc))
                doc, anchor = doc[order], anchor[order]
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                doc, anchor = doc[new], anchor[new]
                n = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers[a:b][doc], pa.int64()),
                        pa.array(ids[a:b][doc], pa.int64()),
                        pa.array(anchor.view(np.int64), pa.int64()),
                        pa.nulls(n, pa.int64()),
                        pa.nulls(n, pa.string()),
                        pa.nulls(n, pa.binary()),
                        pa.array(["anchor"] * n, pa.string()),
                    ],
                    names,
                )

    return run


def _unpack(packed: list[bytes]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Texts of a batch in runs of about a few MB."""
    unsqueeze = zstandard.ZstdDecompressor().decompress
    begin, texts, size = 0, [], 0
    for p in packed:
        texts.append(unsqueeze(p))
        size += len(texts[-1])
        if size > 1_000_000:
            yield begin, begin + len(texts), texts
            begin, texts, size = begin + len(texts), [], 0
    if texts:
        yield begin, begin + len(texts), texts


def _listed(column, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column's rows a..b as (row number, value)."""
    lists = column.slice(a, b - a)
    values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(b - a), sizes), values


def _among(doc: np.ndarray, value: np.ndarray, in_doc: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which (doc, value) pairs are among the (in_doc, wanted) pairs."""
    out = np.zeros(len(doc), dtype=bool)
    first = np.searchsorted(doc, np.arange(doc[-1] + 2)) if len(doc) else np.zeros(1, np.int64)
    at = np.searchsorted(in_doc, np.arange(len(first)))
    for d in np.unique(in_doc).tolist():
        if d + 1 < len(first):
            s = slice(first[d], first[d + 1])
            out[s] = np.isin(value[s], wanted[at[d] : at[d + 1]])
    return out


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("_row").to_numpy(zero_copy_only=False)
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            for a, b, texts in _unpack(batch.column("_packed").to_pylist()):
                v = Windows(texts, window)
                chosen = _among(v.doc, v.anchor, *_listed(batch.column("_anchors"), a, b))
                doc, hashes = v.doc[chosen], v.hashes(chosen)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers[a:b][doc], pa.int64()),
                        pa.array(ids[a:b][doc], pa.int64()),
                        pa.array(hashes.view(np.int64), pa.int64()),
                    ],
                    ["_row", "_id", "_hash"],
                )

    return run


def _cut(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _unpack(batch.column("_packed").to_pylist()):
                v = Windows(texts, window)
                w = v.words
                gone = _among(v.doc, v.hashes(np.ones(len(v.at), dtype=bool)), *_listed(batch.column("_gone"), a, b))
                # Covered words: windows open and close; where any is open, the word goes.
                depth = np.zeros(len(w.start) + 1, dtype=np.int64)
                np.add.at(depth, v.at[gone], 1)
                np.add.at(depth, v.at[gone] + window, -1)
                covered = np.cumsum(depth[:-1]) > 0
                data = w.data.tobytes()
                removed, shas, kept_texts = [], [], []
                for d in range(b - a):
                    s = slice(w.first[d], w.first[d + 1])
                    keep = ~covered[s]
                    removed.append(int(covered[s].sum()))
                    words = [data[x:y] for x, y in zip(w.start[s][keep].tolist(), w.end[s][keep].tolist(), strict=True)]
                    kept = b" ".join(words)
                    shas.append(hashlib.sha256(kept).hexdigest())
                    kept_texts.append(kept.decode("utf-8", "replace") if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(a, b - a),
                        batch.column("_id").slice(a, b - a),
                        pa.array(np.diff(w.first), pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(shas, pa.string()),
                        pa.array(kept_texts, pa.string()),
                    ],
                    ["_row", "_id", "_words", "_removed", "_sha", "_kept"],
                )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for every row.

    ``kept_text``: the kept words joined by one space; null where nothing was removed.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_id"),
        text_bytes(text_col).alias("_text"),
    )
    scanned = stage(
        source.mapInArrow(_scan(window), "_row long, _id long, _hash long, _words long, _sha string, _packed binary, _kind string"),
        "window-scan",
        partition_by="_kind",
    )
    anchors = scanned.where("_kind = 'anchor'").select("_row", "_id", "_hash")
    repeated = anchors.groupBy("_hash").agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi")).where("_lo < _hi")
    # A list is bounded by the row's own text.
    wanted = anchors.join(repeated.select("_hash"), "_hash").groupBy("_row").agg(F.collect_set("_hash").alias("_anchors"))
    packed = scanned.where("_kind = 'doc'").select("_row", "_id", "_packed")
    candidates = stage(packed.join(wanted, "_row"), "window-candidates")
    windows = candidates.mapInArrow(_window_rows(window), "_row long, _id long, _hash long")
    lowest = windows.groupBy("_hash").agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi")).where("_lo < _hi").drop("_hi")
    gone = (
        windows.join(lowest, "_hash")
        .where("_lo < _id")
        .groupBy("_row")
        .agg(F.collect_set("_hash").alias("_gone"))
    )
    cut = candidates.select("_row", "_id", "_packed").join(gone, "_row").mapInArrow(
        _cut(window, with_text), "_row long, _id long, _words long, _removed long, _sha string, _kept string"
    )
    cut = stage(cut if with_text else cut.drop("_kept"), "window-cut")
    whole = scanned.where("_kind = 'doc'").select("_row", "_id", "_words", F.lit(0).cast("long").alias("_removed"), "_sha")
    whole = whole.join(cut.select("_row"), "_row", "left_anti")
    out = cut.unionByName(whole, allowMissingColumns=with_text)
    doc_id = F.when(F.col("_id") != LAST, F.col("_id")).alias("doc_id")
    columns = [doc_id, F.col("_words").alias("n_words"), F.col("_removed").alias("n_removed"), F.col("_sha").alias("kept_sha256")]
    return out.select(*columns, *([F.col("_kept").alias("kept_text")] if with_text else []))
