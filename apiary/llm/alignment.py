"""Two tokenizers aligned byte by byte: interval coalescing.

A text is encoded twice: with a leading space by a byte-level vocabulary (A) and
by a piece vocabulary that adds the space itself (B). All A and B tokens of a
batch are sorted by their first byte; where a token starts at or beyond the running
maximum of the ends before it (``maximum.accumulate``), a group ends. Within the
groups the overlapping A and B tokens are expanded by two binary searches, never as
a product, so a group of any length costs its tokens. Overlapping tokens that end
together are links.

Neither tokenizer joins a character to the space after it, so a text is cut there
into units, and each distinct unit is encoded and aligned once per task (at most
``REMEMBERED`` are kept). The exact check per unit is that the joined bytes of both
sides equal the unit.

Counts of linked id pairs cover all documents. Pairs that hold at least one of
``HOT`` links number at most ``HOT``: they are sent to every task. The rare rest is joined
by a shuffle on the pair, where no pair is hot.

Defined cases: texts null, empty, or not equal to both sides' bytes (such as
U+2581 in the text) have no tokens: zeros and an empty digest; bytes that are no
UTF-8 count as U+FFFD; repeated ids and rows each give a row; a null id stays null;
texts of any length are processed whole; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.llm.bpe import byte_alphabet, default_path
from apiary.llm.common import small_batches, stage, text_bytes

# Distinct units a task remembers before its memory is cleared.
REMEMBERED = 300_000
# Units encoded as one text.
CHUNK = 5_000
# A pair with at least 1/HOT of all links is sent to every task (at most HOT pairs, 2 MB).
HOT = 1 << 17
# Pairs a task holds before it hands on their counts.
HELD_PAIRS = 1_000_000

_SPACE_BEFORE_SPACE = re.compile(r"\s ")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def piece_path() -> str:
    """Place of the public piece vocabulary."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path("piece_bpe_32k.model"))


class Pair:
    """Both tokenizers, and the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes((int(byte[1], 16),)) if byte else piece.replace("▁", " ").encode())
        self.size_b = len(self.bytes_b)
        self.blank = self.b.piece_to_id("▁")
        self.length_a = np.array([len(t) for t in self.bytes_a])
        self.length_b = np.array([len(t) for t in self.bytes_b])
        # Every id in decimal, followed by each of the three marks.
        self.written = [f"{i}{mark}" for i in range(max(len(self.bytes_a), self.size_b)) for mark in ",|;"]

    def encode(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids per unit) of A and of B for units, each of which starts with a space; none where the bytes differ."""
        a = [np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # The piece tokenizer adds the first space itself; an empty text gets none.
        b = [np.array(self.b.encode(u[1:]) if len(u) > 1 else [self.blank], dtype=np.int64) for u in units]
        for i, unit in enumerate(units):
            raw = unit.encode()
            if self.joined(self.bytes_a, a[i]) != raw or self.joined(self.bytes_b, b[i]) != raw:
                a[i] = b[i] = np.zeros(0, dtype=np.int64)
        return [(np.concatenate(ids), np.array([len(x) for x in ids])) for ids in (a, b)]

    @staticmethod
    def joined(table: list[bytes], ids: np.ndarray) -> bytes:
        return b"".join(map(table.__getitem__, ids.tolist()))

    def encode_chunk(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same, all units as one text where that is sound: same bytes, and a token ends where a unit ends."""
        text = "".join(units)
        raw = text.encode()
        ends = np.cumsum([len(u.encode()) for u in units])
        out = []
        for ids, table, length in (
            (self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.bytes_a, self.length_a),
            (self.b.encode(text[1:]), self.bytes_b, self.length_b),
        ):
            ids = np.array(ids, dtype=np.int64)
            upto = np.cumsum(length[ids])
            cut = np.searchsorted(upto, ends)
            if self.joined(table, ids) != raw or not np.array_equal(upto[cut], ends):
                return self.encode(units)
            out.append((ids, np.diff(cut, prepend=-1)))
        return out


_LOADED: dict[tuple[str, str], Pair] = {}


def load(path_a: str, path_b: str) -> Pair:
    """The tokenizers of these files, kept per process."""
    if (path_a, path_b) not in _LOADED:
        _LOADED.clear()
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


def units(text: str) -> list[str]:
    """A space and the text, cut before each space that follows a character other than white space."""
    words = [" " + w for w in text.split(" ")]
    if _SPACE_BEFORE_SPACE.search(" " + text) is None:
        return words
    out = words[:1]
    for word in words[1:]:
        if out[-1][-1].isspace():
            out[-1] += word
        else:
            out.append(word)
    return out


@dataclass
class Groups:
    """Tokens of a batch in groups: ``group_a`` / ``group_b`` hold each token's group."""

    group_a: np.ndarray
    group_b: np.ndarray
    n: int


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> Groups:
    """Groups of overlapping intervals of two lists, each in order."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), dtype=bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return Groups(group[: len(start_a)], group[len(start_a) :], int(new.sum()))


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of all overlapping intervals; each list tiles its range, in order."""
    first = np.searchsorted(end_b, start_a, "right")
    last = np.searchsorted(start_b, end_a, "left")
    count = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(start_a)), count)
    within = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    return a, first[a] + within


class Aligner:
    """Aligned units of one task, each encoded once."""

    def __init__(self, pair: Pair, remembered: int = REMEMBERED):
        self.pair, self.remembered = pair, remembered
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[str] = []
        self.numbers = np.zeros((0, 5), dtype=np.int64)
        self.link_at = np.zeros(1, dtype=np.int64)
        self.link = np.zeros(0, dtype=np.int64)

    def learn(self, new: list[str]) -> None:
        """Encode and align units not seen before."""
        chunks = [self.pair.encode_chunk(new[lo : lo + CHUNK]) for lo in range(0, len(new), CHUNK)]
        (flat_a, n_a), (flat_b, n_b) = ([np.concatenate(x) for x in zip(*side)] for side in zip(*chunks))
        end_a, end_b = np.cumsum(self.pair.length_a[flat_a]), np.cumsum(self.pair.length_b[flat_b])
        start_a, start_b = end_a - self.pair.length_a[flat_a], end_b - self.pair.length_b[flat_b]
        groups = coalesce(start_a, end_a, start_b, end_b)
        a, b = overlaps(start_a, end_a, start_b, end_b)
        together = end_a[a] == end_b[b]
        a, b = a[together], b[together]
        n_links = np.bincount(np.repeat(np.arange(len(new)), n_a)[a], minlength=len(new))
        # All tokens as text, a group's A ids before its B ids, each with the mark that follows it.
        numbers = np.arange(groups.n + 1)
        bound_a, bound_b = np.searchsorted(groups.group_a, numbers), np.searchsorted(groups.group_b, numbers)
        written = np.empty(len(flat_a) + len(flat_b), dtype=np.int64)
        for group, ids, offset, last, mark in (
            (groups.group_a, flat_a, bound_b[:-1], bound_a[1:], 1),
            (groups.group_b, flat_b, bound_a[1:], bound_b[1:], 2),
        ):
            at = np.arange(len(ids))
            written[at + offset[group]] = ids * 3 + np.where(at + 1 == last[group], mark, 0)
        table = self.pair.written
        texts = list(map(table.__getitem__, written.tolist()))
        bound = np.append(0, np.cumsum(n_a + n_b)).tolist()
        self.text += ["".join(texts[x:y]) for x, y in zip(bound, bound[1:])]
        # A unit's groups: from that of its first A token to that of the next unit's.
        first_group = np.append(groups.group_a, groups.n)[np.cumsum(n_a) - n_a]
        last_group = np.append(first_group[1:], groups.n)
        found = np.column_stack([n_a, n_b, last_group - first_group, n_links, n_a > 0])
        self.numbers = np.concatenate([self.numbers, found])
        self.link = np.concatenate([self.link, flat_a[a] * self.pair.size_b + flat_b[b]])
        self.link_at = np.concatenate([self.link_at, self.link_at[-1] + np.cumsum(n_links)])
        for u in new:
            self.place[u] = len(self.place)

    def prepare(self, texts: list[str | None]) -> list[list[str]]:
        """The units of each text of a batch; all new ones are learnt at once."""
        parts = [units(t) if t else [] for t in texts]
        seen = dict.fromkeys(chain.from_iterable(parts))
        new = [u for u in seen if u not in self.place]
        if len(self.place) + len(new) > self.remembered:
            self.forget()
            new = list(seen)
        if new:
            self.learn(new)
        return parts

    def align(self, parts: list[str]) -> tuple[np.ndarray, str, np.ndarray]:
        """Of a prepared text: (n_a, n_b, n_groups, n_links), its groups as text, its linked pairs."""
        at = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
        numbers = self.numbers[at]
        if not parts or not numbers[:, 4].all():
            return np.zeros(4, dtype=np.int64), "", np.zeros(0, dtype=np.int64)
        count = numbers[:, 3]
        total = np.cumsum(count)
        index = np.arange(total[-1]) + np.repeat(self.link_at[at] - total + count, count)
        return numbers[:, :4].sum(axis=0), "".join(map(self.text.__getitem__, at.tolist()))[:-1], self.link[index]


def _texts(batch: pa.RecordBatch) -> list[str | None]:
    return [None if t is None else t.decode("utf-8", "replace") for t in batch.column("_text").to_pylist()]


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text aligned: doc_id, numbers, ``groups`` (``a1,a2|b1;a3|b2``), linked ``pairs`` and their ``times``.

    A pair is A id times the size of B's vocabulary plus B id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(load(path_a, path_b))
        for whole in batches:
            # About 2,000 kB of text at a time.
            size = np.cumsum([len(t) if t is not None else 0 for t in whole.column("_text").to_pylist()])
            cut = np.flatnonzero(np.diff(size // 2_000_000, prepend=0)).tolist()
            for lo, hi in zip([0, *cut], [*cut, whole.num_rows]):
                batch = whole.slice(lo, hi - lo)
                if not batch.num_rows:
                    continue
                numbers, groups, pairs, times = [], [], [], []
                for parts in aligner.prepare(_texts(batch)):
                    n, g, links = aligner.align(parts)
                    pair, k = np.unique(links, return_counts=True)
                    numbers.append(n)
                    groups.append(g)
                    pairs.append(pair)
                    times.append(k)
                columns = np.array(numbers, dtype=np.int64).reshape(-1, 4).T
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"), *(pa.array(c) for c in columns), pa.array(groups, pa.large_string()).cast(pa.string()),
                        pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
    return rows.mapInArrow(run, schema)


def _pair_counts(staged: DataFrame) -> DataFrame:
    """(pair, f): links of each pair, summed in the task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(f)], ["pair", "f"])

        for batch in batches:
            more = [batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pairs", "times")]
            pair, which = np.unique(np.concatenate([pair, more[0]]), return_inverse=True)
            f = np.bincount(which.reshape(-1), np.concatenate([f, more[1]]), len(pair)).astype(np.int64)
            if len(pair) > HELD_PAIRS:
                yield out()
                pair, f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield out()

    return staged.select("pairs", "times").mapInArrow(run, "pair long, f long").groupBy("pair").agg(F.sum("f").alias("f"))


def link_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    path_a, path_b = path_a or default_path(), path_b or piece_path()
    spark = docs.sparkSession
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups"), 256))
    staged = stage(
        aligned(docs, path_a, path_b)
        .withColumn("groups_sha256", digest)
        .drop("groups")
        .withColumn("_row", F.monotonically_increasing_id()),
        "alignment",
    )
    size_b = load(path_a, path_b).size_b
    counts = stage(_pair_counts(staged), "alignment-pairs").withColumn("_b", F.col("pair") % size_b)
    # One row per id of B: bounded by its vocabulary.
    highest = counts.groupBy("_b").agg(F.max("f").alias("_most"))
    pairs = counts.join(F.broadcast(highest), "_b").select("pair", "f", (F.col("f") == F.col("_most")).alias("best"))
    total = counts.agg(F.sum("f")).first()[0] or 0
    often = F.col("f") * hot >= F.lit(total)
    top = pairs.where(often).orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "f", "best")))

    def split(batch: pa.RecordBatch):
        pair, f, best = sent.value
        lists = batch.column("pairs")
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        held = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        k = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(pair, held)
        at[at == len(pair)] = 0
        hit = pair[at] == held if len(pair) else np.zeros(len(held), dtype=bool)
        return row, held, k, hit, f[at[hit]], best[at[hit]]

    def of_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, _, k, hit, f, best = split(batch)
            sums = []
            for value in (k[hit] * best, k[hit] * f):
                upto = np.append(0, np.cumsum(value))
                sums.append(np.diff(upto[np.searchsorted(row[hit], np.arange(batch.num_rows + 1))]))
            columns = [batch.column(c) for c in batch.schema.names[:-2]] + [pa.array(s.astype(np.int64)) for s in sums]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "_best", "_sum"])

    def of_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, held, k, hit, _, _ = split(batch)
            rows = batch.column("_row").to_numpy()[row]
            for lo in range(0, len(rows), 200_000):
                part = np.arange(lo, min(lo + 200_000, len(rows)))[~hit[lo : lo + 200_000]]
                yield pa.RecordBatch.from_arrays([pa.array(rows[part]), pa.array(held[part]), pa.array(k[part])], ["_row", "pair", "k"])

    plain = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rare = (
        staged.select("_row", "pairs", "times")
        .mapInArrow(of_rare, "_row long, pair long, k long")
        .join(pairs.where(~often), "pair")
        .groupBy("_row")
        .agg(F.sum(F.when(F.col("best"), F.col("k"))).alias("_more_best"), F.sum(F.col("k") * F.col("f")).alias("_more_sum"))
    )
    schema = "_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, _best long, _sum long"
    return (
        staged.select(*plain, "pairs", "times")
        .mapInArrow(of_hot, schema)
        .join(rare, "_row", "left")
        .select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            (F.col("_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
            (F.col("_sum") + F.coalesce("_more_sum", F.lit(0))).alias("count_sum"),
            "groups_sha256",
        )
    )
