"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

Inputs of a score: the words of the text, hashed to ``WORD_SLOTS`` slots (square
root of the count, unit length); statistics of its structure (shares of
character kinds, repetition, word and line lengths) in ``LEVELS`` levels each;
and the metadata column ``n_chars`` in levels. Every pair of inputs interacts
through the product of two rank-``RANK`` vectors; with the sum-of-squares
identity a text is scored in time linear in its distinct words:
``w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2)``.

The model is fitted on a bounded sample of labelled rows: at most
``TRAIN_ROWS`` documents of each class, those with the smallest hash of the id,
never a held-out one. The sample and the model do not grow with the corpus;
scoring is one pass without a shuffle.

Defined cases: a null or empty text has no words and is scored by its
statistics; null metadata has a level of its own; a null id is not held out and
never trained on; of repeated label rows the largest counts, null labels are
ignored; of repeated ids the smallest text is trained on and every row is
scored; without labelled rows the score is 0.5, with one class only it is that
class; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apiary.llm.common import fresh, text_bytes
from apiary.llm.words import Words, batches_of_bytes

WORD_SLOTS = 1 << 14
LEVELS = 16
RANK = 8
TRAIN_ROWS = 3000
EPOCHS = 6
FOLDS, HELD_OUT_FOLD = 3, 1

_UPPER, _LOWER, _DIGIT, _MARK, _BLANK, _HIGH = range(6)
_KIND = np.full(256, _MARK, dtype=np.int8)
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _BLANK
_KIND[0x80:] = _HIGH


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


@dataclass
class Features:
    """Inputs of a batch: word slots as (document, slot, value), statistics as one level each."""

    doc: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    levels: np.ndarray  # documents x statistics: input numbers

    @property
    def n(self) -> int:
        return len(self.levels)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Levels of a share: finer near 0."""
    return np.minimum(LEVELS - 1, np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)) * LEVELS).astype(np.int64)


def _scale(x: np.ndarray, per_doubling: float = 1.0) -> np.ndarray:
    return np.minimum(LEVELS - 1, np.log2(1 + np.maximum(x, 0)) * per_doubling).astype(np.int64)


def featurize(texts: list[bytes | None], n_chars: list[int | None]) -> Features:
    w = Words(texts)
    docs = len(texts)
    words = np.diff(w.first)
    of_word = np.repeat(np.arange(docs), words)
    h = w.hashes()
    slot_key, counts = np.unique(of_word.astype(np.int64) * WORD_SLOTS + (h % np.uint64(WORD_SLOTS)).astype(np.int64), return_counts=True)
    doc, slot = np.divmod(slot_key, WORD_SLOTS)
    value = np.sqrt(counts)
    value = value / np.sqrt(np.bincount(doc, counts, docs))[doc]

    lengths = np.array([len(t) if t else 0 for t in texts], dtype=np.int64)
    kind = _KIND[w.data[:-1]] if docs else _KIND[:0]
    of_byte = np.repeat(np.arange(docs), lengths + (np.arange(docs) < docs - 1)) if docs else np.zeros(0, np.int64)
    per_kind = np.bincount(of_byte * 6 + kind, minlength=docs * 6).reshape(docs, 6)
    per_kind[: docs - 1, _BLANK] -= 1  # the spaces put between texts
    letters = per_kind[:, _UPPER] + per_kind[:, _LOWER] + per_kind[:, _HIGH]

    def per_doc(flag: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner[flag], minlength=docs)

    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    distinct = per_doc(np.ones(len(doc), bool), doc)
    ends = w.data[w.end - 1] if len(h) else w.data[:0]
    twice = np.zeros(len(kind), dtype=bool)
    twice[1:] = (w.data[1:-1] == w.data[:-2]) & (kind[1:] == _MARK) if docs else twice[1:]
    lines = per_doc(w.data[:-1] == 0x0A, of_byte) if docs else np.zeros(0, np.int64)
    long_word = (w.end - w.start) > 20
    all_caps = np.zeros(len(h), dtype=bool)
    if len(h):
        upper = np.concatenate([[0], np.cumsum(_KIND[w.data] == _UPPER)])
        lower = np.concatenate([[0], np.cumsum(_KIND[w.data] == _LOWER)])
        all_caps = (upper[w.end] - upper[w.start] > 1) & (lower[w.end] == lower[w.start])
    chars = np.array([-1 if c is None else c for c in n_chars], dtype=np.float64)
    stats = [
        _share(letters, lengths),
        _share(per_kind[:, _UPPER], letters),
        _share(per_kind[:, _DIGIT], lengths),
        _share(per_kind[:, _MARK], lengths),
        _share(per_kind[:, _HIGH], lengths),
        _share(per_kind[:, _BLANK], lengths),
        _scale(np.bincount(of_word, w.end - w.start, docs) / np.maximum(words, 1), 3),
        _share(distinct, words),
        _share(per_doc(same, of_word), words),
        _share(per_doc(_KIND[ends] == _MARK, of_word), words),
        _share(per_doc(twice, of_byte), lengths),
        _scale(words / (1 + lines), 2),
        _scale(words),
        _share(per_doc(long_word, of_word), words),
        _share(per_doc(all_caps, of_word), words),
        np.where(chars < 0, LEVELS - 1, np.minimum(_scale(chars, 0.8), LEVELS - 2)),
    ]
    offset = WORD_SLOTS + np.arange(len(stats)) * LEVELS
    return Features(doc, slot, value, np.stack(stats, axis=1) + offset if docs else np.zeros((0, len(stats)), np.int64))


STATISTICS = 16
INPUTS = WORD_SLOTS + STATISTICS * LEVELS
# Value of a statistic's level: with 16 of them the structure inputs have unit length too.
LEVEL_VALUE = STATISTICS**-0.5


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def _sums(self, x: Features) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores, and the factor sums of each document."""
        v = self.factors[x.slot] * x.value[:, None]
        lv = self.factors[x.levels] * LEVEL_VALUE
        edge = np.searchsorted(x.doc, np.arange(x.n + 1))

        def per_doc(a: np.ndarray) -> np.ndarray:
            upto = np.concatenate([np.zeros((1, *a.shape[1:])), np.cumsum(a, axis=0)])
            return upto[edge[1:]] - upto[edge[:-1]]

        sums = per_doc(v) + lv.sum(axis=1)
        squares = per_doc(v * v) + (lv * lv).sum(axis=1)
        raw = self.bias + per_doc(self.linear[x.slot] * x.value) + self.linear[x.levels].sum(axis=1) * LEVEL_VALUE
        return raw + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, x: Features) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self._sums(x)[0], -30, 30)))


def _take(x: Features, chosen: np.ndarray) -> Features:
    edge = np.searchsorted(x.doc, np.arange(x.n + 1))
    size = edge[chosen + 1] - edge[chosen]
    at = np.arange(size.sum()) + np.repeat(edge[chosen] - np.cumsum(size) + size, size)
    return Features(np.repeat(np.arange(len(chosen)), size), x.slot[at], x.value[at], x.levels[chosen])


def fit(x: Features, label: np.ndarray, prior: float = 0.5, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.1, decay: float = 1e-5) -> Model:
    """Logistic loss, mini-batches, AdaGrad; class 1 weighs ``prior``. Fixed seed: refits agree."""
    rng = np.random.default_rng(7)
    model = Model(0.0, np.zeros(INPUTS), rng.normal(0, 0.02, (INPUTS, RANK)))
    positive = label.mean() if len(label) else 0.0
    if not len(label) or positive in (0.0, 1.0):
        model.bias = 0.0 if not len(label) else 30.0 * (2 * positive - 1)
        model.factors[:] = 0.0
        return model
    weight = np.where(label == 1, prior / positive, (1 - prior) / (1 - positive))
    seen_b, seen_w, seen_v = 1e-8, np.full(INPUTS, 1e-8), np.full((INPUTS, RANK), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(x.n)
        for i in range(0, x.n, batch):
            chosen = order[i : i + batch]
            b = _take(x, chosen)
            raw, sums = model._sums(b)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[chosen]) * weight[chosen] / len(chosen)
            grad_w, grad_v = decay * model.linear, decay * model.factors
            np.add.at(grad_w, b.slot, g[b.doc] * b.value)
            v = model.factors[b.slot]
            np.add.at(grad_v, b.slot, (g[b.doc] * b.value)[:, None] * (sums[b.doc] - v * b.value[:, None]))
            np.add.at(grad_w, b.levels, (g * LEVEL_VALUE)[:, None])
            lv = model.factors[b.levels]
            np.add.at(grad_v, b.levels, (g * LEVEL_VALUE)[:, None, None] * (sums[:, None, :] - lv * LEVEL_VALUE))
            seen_w += grad_w**2
            seen_v += grad_v**2
            seen_b += g.sum() ** 2
            model.linear -= rate * grad_w / np.sqrt(seen_w)
            model.factors -= rate * grad_v / np.sqrt(seen_v)
            model.bias -= rate * g.sum() / np.sqrt(seen_b)
    return Model(model.bias, model.linear.astype(np.float32), model.factors.astype(np.float32))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """(label, text, n_chars) of at most ``rows`` labelled documents of each class, none held out."""
    known = known_labels(labels, label_col)
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = known.where("_label = 0").orderBy(*order).limit(rows).unionByName(known.where("_label = 1").orderBy(*order).limit(rows))
    # At most 2 * rows ids: broadcast.
    found = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.struct(text_bytes(text_col).alias("text"), F.col(chars_col).cast("long").alias("n_chars")).alias("_doc")
    ).join(F.broadcast(chosen), "_id")
    return found.groupBy("_id", "_label").agg(F.min("_doc").alias("_doc")).select("_id", "_label", "_doc.text", "_doc.n_chars")


def known_labels(labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(_id, _label) of the labelled ids that may be learned from."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )


def train(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """Fit on the bounded sample; the classes weigh as in all labelled rows that may be learned from."""
    prior = known_labels(labels, options.get("label_col", "quality")).agg(F.avg("_label")).first()[0]
    schema = "_id long, _label int, slots array<int>, counts array<float>, levels array<int>"
    rows = training_sample(docs, labels, **options).mapInArrow(_inputs, schema).toArrow().sort_by("_id").combine_chunks()
    if not rows.num_rows:
        return fit(featurize([], []), np.zeros(0))
    size = np.array(rows["slots"].combine_chunks().value_lengths())
    x = Features(
        np.repeat(np.arange(rows.num_rows), size),
        np.array(rows["slots"].combine_chunks().flatten(), dtype=np.int64),
        np.array(rows["counts"].combine_chunks().flatten(), dtype=np.float64),
        np.array(rows["levels"].combine_chunks().flatten(), dtype=np.int64).reshape(rows.num_rows, STATISTICS),
    )
    return fit(x, np.array(rows["_label"], dtype=np.float64), prior)


def _inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The inputs of the sampled documents, worked out where their texts are."""
    for batch in batches:
        texts, chars = batch.column("text").to_pylist(), batch.column("n_chars").to_pylist()
        for a, b in batches_of_bytes(texts):
            x = featurize(texts[a:b], chars[a:b])
            edge = pa.array(np.searchsorted(x.doc, np.arange(x.n + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").slice(a, b - a),
                    batch.column("_label").slice(a, b - a),
                    pa.ListArray.from_arrays(edge, pa.array(x.slot, pa.int32())),
                    pa.ListArray.from_arrays(edge, pa.array(x.value, pa.float32())),
                    pa.array(x.levels.tolist(), pa.list_(pa.int32())),
                ],
                ["_id", "_label", "slots", "counts", "levels"],
            )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chars = batch.column("_text").to_pylist(), batch.column("_chars").to_pylist()
            for a, b in batches_of_bytes(texts):
                s = model.score(featurize(texts[a:b], chars[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(a, b - a),
                        batch.column("_held").slice(a, b - a),
                        pa.array(s, pa.float64()),
                        pa.array((s >= 0.5).astype(np.int32), pa.int32()),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        held_out(id_col).alias("_held"),
        text_bytes(text_col).alias("_text"),
        F.col(chars_col).cast("long").alias("_chars"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that the model accepts, unchanged; no shuffle."""
    names = docs.columns
    raw, size = fresh("text"), fresh("chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chars = batch.column(raw).to_pylist(), batch.column(size).to_pylist()
            keep = np.zeros(len(texts), dtype=bool)
            for a, b in batches_of_bytes(texts):
                keep[a:b] = model.score(featurize(texts[a:b], chars[a:b])) >= 0.5
            yield batch.select(names).filter(pa.array(keep))

    rows = docs.select("*", text_bytes(text_col).alias(raw), F.col(chars_col).cast("long").alias(size))
    return rows.mapInArrow(run, docs.schema)
