"""Phrase collocations: n-grams counted in burst tries, then cut scores.

Words are counted first, then phrases of two words, of three, and so on. A
phrase of n words can be frequent only if its first and its last n - 1 words
are, so each pass looks at the phrases whose two parts passed a filter built
from the frequent phrases of the pass before. The filter is a Bloom filter of
fixed size (``FILTER_BITS``): it may let a rare phrase through, it never stops a
frequent one, and however full it gets only the work grows, never the result.
Phrases of two words, of which most are rare, go through one more filter:
their occurrences are first counted by hash bucket (``BUCKETS``, each task's counts
travel as compressed runs of one part of the buckets), and a phrase whose
bucket stays below the least count is not looked at. Again a rare phrase may pass,
a frequent one always does.

Counting in a task (:class:`BurstTrie`): a shallow trie over word numbers holds
hash containers of phrase ends. A container beyond ``BURST`` entries bursts into
a node with one container per next word. When the trie holds ``KEPT`` entries, its
largest subtrees leave as whole, as sorted runs, until half of it is free. The
runs are dealt by a hash of their prefix (the first word, and which of 64 parts the
second word belongs to) and merged there; what is dealt is already summed by its task,
so a hot first word sends at most its distinct phrases of each task, in 64 parts.

Scores use exact integers (decimals of 38 digits). Defined cases: a null text
counts as empty, a null language is ``und``; ids are not read, so repeated rows
count each; texts of any length are processed whole; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apiary.llm.common import small_batches, stage, text_bytes
from apiary.llm.words import U64, hash_runs, mix

# Bits of the filter of frequent phrases; at most an eighth of it in bytes is sent to each worker.
FILTER_BITS = 1 << 26
# Buckets of the count of two-word phrases (a power of two), and of one run of them.
BUCKETS = 1 << 26
SEGMENT = 1 << 16
# Buckets a task holds before it hands on their counts.
HELD_BUCKETS = 2_000_000
# Entries of a container before it bursts, and of a trie before its largest subtrees are spilled.
BURST = 4096
KEPT = 400_000
# Distinct words a task remembers before it spills its whole trie and starts anew. A block of texts may add
# two BLOCKs of them before that is seen, so a number always fits WORD_BITS bits.
REMEMBERED = 400_000
WORD_BITS = 20
# Tokens worked on at once.
BLOCK = 250_000
PARTS = 64
NO_LANG = "und"

_BREAK = b"."
_TABLE = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _c + 32
_TABLE[0x09] = 0x20
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = _BREAK[0]
_TABLE = bytes(_TABLE)
_STEP = U64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text; a single full stop stands for every cut between pieces."""
    return text.translate(_TABLE).replace(_BREAK, b" . ").split()


class _Numbers(dict):
    """Numbers words in order of first sight and keeps them; hashes are worked out for many at once."""

    def __init__(self, first: bytes):
        super().__init__()
        self.words: list[bytes] = []
        self._hash = np.zeros(0, dtype=U64)
        self[first]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def hashes(self) -> np.ndarray:
        new = self.words[len(self._hash) :]
        if new:
            self._hash = np.concatenate([self._hash, name_hashes(new)])
        return self._hash


def name_hashes(names: list[bytes]) -> np.ndarray:
    """64-bit hash of each byte string (used by the filter only, never to tell words apart)."""
    length = np.fromiter(map(len, names), np.int64, len(names))
    end = np.cumsum(length)
    return hash_runs(np.frombuffer(b"".join(names) or b" ", dtype=np.uint8), end - length, end)


class BurstTrie:
    """Counts of phrases of ``n`` words (numbers below 2**WORD_BITS) in hash containers below a shallow trie.

    A subtree belongs to one head: language and first word (language alone for single words, two words of a phrase
    of five), so that the rest of a phrase always fits one 64-bit key. A node is ``[children, None]``, a container ``[None, counts by key]``.
    """

    def __init__(self, n: int, burst: int = BURST):
        self.n, self.burst = n, burst
        self.heads = min(n - 1, max(1, n - 3))
        self.rest = n - self.heads
        self.root: dict[tuple, list] = {}
        self.size: dict[tuple, int] = {}
        self.entries = 0

    def add(self, columns: list[np.ndarray], counts: np.ndarray) -> None:
        """Add distinct phrases, given as columns (language, words) in sorted order."""
        head = columns[: 1 + self.heads]
        key = np.zeros(len(counts), dtype=np.int64)
        for column in columns[1 + self.heads :]:
            key = key << WORD_BITS | column
        new = np.zeros(len(counts), dtype=bool)
        new[:1] = True
        for column in head:
            new[1:] |= column[1:] != column[:-1]
        at = np.flatnonzero(new)
        names = list(zip(*(column[at].tolist() for column in head)))
        bounds = [*at.tolist(), len(counts)]
        key, counts = key.tolist(), counts.tolist()
        for i, name in enumerate(names):
            place = self.root.get(name)
            if place is None:
                place = self.root[name] = [None, {}]
            lo, hi = bounds[i], bounds[i + 1]
            grown = self._put(place, key[lo:hi], counts[lo:hi], self.rest)
            self.entries += grown
            self.size[name] = self.size.get(name, 0) + grown

    def _put(self, place: list, key: list[int], counts: list[int], rest: int) -> int:
        held = place[1]
        if held is not None:
            before = len(held)
            get = held.get
            for k, c in zip(key, counts):
                held[k] = get(k, 0) + c
            grown = len(held) - before
            if len(held) > self.burst and rest > 1:
                place[0], place[1] = {}, None
                self._deal(place, list(held), list(held.values()), rest)
            return grown
        return self._deal(place, key, counts, rest)

    def _deal(self, place: list, key: list[int], counts: list[int], rest: int) -> int:
        shift = WORD_BITS * (rest - 1)
        parts: dict[int, tuple[list, list]] = {}
        for k, c in zip(key, counts):
            part = parts.setdefault(k >> shift, ([], []))
            part[0].append(k & (1 << shift) - 1)
            part[1].append(c)
        grown = 0
        for step, (ks, cs) in parts.items():
            below = place[0].get(step)
            if below is None:
                below = place[0][step] = [None, {}]
            grown += self._put(below, ks, cs, rest - 1)
        return grown

    def _walk(self, place: list, above: int, rest: int) -> Iterator[tuple[int, dict]]:
        if place[0] is None:
            yield above << WORD_BITS * rest, place[1]
        else:
            for step, below in place[0].items():
                yield from self._walk(below, above << WORD_BITS | step, rest - 1)

    def spill(self, keep: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Whole subtrees, largest first, until at most ``keep`` entries stay: columns and counts."""
        names, sizes, keys, counts = [], [], [], []
        for name in sorted(self.size, key=self.size.get, reverse=True):
            if self.entries <= keep:
                break
            size = self.size.pop(name)
            self.entries -= size
            names.append(name)
            sizes.append(size)
            for above, held in self._walk(self.root.pop(name), 0, self.rest):
                keys.append(np.fromiter(held, np.int64, len(held)) + above)
                counts.append(np.fromiter(held.values(), np.int64, len(held)))
        if not names:
            return [], np.zeros(0, np.int64)
        key = np.concatenate(keys)
        columns = [np.repeat(np.array(column, dtype=np.int64), sizes) for column in zip(*names)]
        for k in range(self.rest - 1, -1, -1):
            columns.append(key >> WORD_BITS * k & (1 << WORD_BITS) - 1)
        return columns, np.concatenate(counts)


def _in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), dtype=bool)
    for at in _places(h, len(bits) * 64):
        ok &= (bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) == 1
    return ok


def _places(h: np.ndarray, size: int) -> list[np.ndarray]:
    """Three bits of a filter of ``size`` bits (a power of two) for each hash."""
    again = mix(h ^ _STEP)
    return [x & U64(size - 1) for x in (h, again, again >> U64(32))]


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``columns`` (numbers below 2**31), sorted, and the count of each."""
    key = columns[0].astype(np.int64)
    kept: list[np.ndarray] = []
    for i, column in enumerate(columns[1:], 1):
        key, row, count = np.unique(key << 31 | column, return_inverse=True, return_counts=True)
        above = key >> 31
        kept = [above] if i == 1 else [k[above] for k in kept]
        kept.append(key & (1 << 31) - 1)
        key = row.reshape(-1)
    return kept, count


class PhraseCounter:
    """Phrases of ``n`` words of one task, as sorted runs (lang, part, phrase, f)."""

    SCHEMA = "lang string, part int, phrase string, f long"

    def __init__(
        self,
        n: int,
        bits: np.ndarray | None = None,
        buckets: np.ndarray | None = None,
        kept: int = KEPT,
        remembered: int = REMEMBERED,
        burst: int = BURST,
    ):
        self.n, self.bits, self.buckets = n, bits, buckets
        self.kept, self.remembered, self.burst = kept, remembered, burst
        self.clear()

    def clear(self) -> None:
        self.words, self.langs = _Numbers(_BREAK), _Numbers(NO_LANG.encode())
        self.trie = BurstTrie(self.n, self.burst)

    def run(self, spilled: tuple[list[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
        """One sorted run: rows by language and words, in byte order."""
        columns, counts = spilled
        if not columns:
            return
        words, langs = (pa.array(names.words, pa.binary()) for names in (self.words, self.langs))
        rank, lang_rank = (np.argsort(pc.sort_indices(names).to_numpy()) for names in (words, langs))
        order = np.lexsort([rank[c] for c in columns[:0:-1]] + [lang_rank[columns[0]]])
        hashes = self.words.hashes()
        for at in range(0, len(order), 100_000):
            rows = order[at : at + 100_000]
            taken = [words.take(pa.array(c[rows])) for c in columns[1:]]
            phrase = taken[0] if self.n == 1 else pc.binary_join_element_wise(*taken, b" ")
            part = hashes[columns[1][rows]]
            if self.n > 1:
                part = mix(part * _STEP + hashes[columns[2][rows]] % U64(PARTS))
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(columns[0][rows])).cast(pa.string()),
                    pa.array((part & U64(0x7FFFFFFF)).astype(np.int32)), phrase.cast(pa.string()), pa.array(counts[rows]),
                ],
                names=["lang", "part", "phrase", "f"],
            )

    def hashes(self, langs: np.ndarray, ids: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
        """Hash of the language and of words ``first`` to ``last - 1`` after each position."""
        word_hash, h = self.words.hashes(), self.langs.hashes()[langs[at]]
        for k in range(first, last):
            h = mix(h * _STEP + word_hash[ids[at + k]])
        return h

    def places(self, langs: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Positions where a phrase starts that may be frequent."""
        n, m = self.n, len(ids) - self.n + 1
        if n == 1 or m <= 0:
            return np.flatnonzero(ids) if n == 1 else np.zeros(0, np.int64)
        ok = ids[:m] != 0
        for k in range(1, n):
            ok &= ids[k : k + m] != 0
        # Each text ends with a cut, so a phrase has one language.
        at = np.flatnonzero(ok)
        for first in (0, 1):
            at = at[_in_filter(self.bits, self.hashes(langs, ids, at, first, first + n - 1))]
        if self.buckets is not None:
            at = at[_in_buckets(self.buckets, self.hashes(langs, ids, at, 0, n))]
        return at

    def block(self, lang: list[int], parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Count the phrases of some texts: language and token numbers (ending with a cut) of each."""
        ids = np.concatenate(parts)
        langs = np.repeat(np.array(lang, dtype=np.int64), [len(p) for p in parts])
        at = self.places(langs, ids)
        if len(at):
            yield from self.count(langs, ids, at)
        if len(self.words.words) > self.remembered:
            yield from self.finish()
            self.clear()

    def count(self, langs: np.ndarray, ids: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.trie.add(*_distinct([langs[at], *(ids[at + k] for k in range(self.n))]))
        if self.trie.entries > self.kept:
            yield from self.run(self.trie.spill(self.kept // 2))

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.run(self.trie.spill(0))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, parts, size = [], [], 0
        for batch in batches:
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                found = tokens(text)
                for at in range(0, len(found), BLOCK):
                    # A long text goes in blocks that share their last n - 1 tokens.
                    part = found[at : at + BLOCK + self.n - 1]
                    ids = np.zeros(len(part) + 1, dtype=np.int64)
                    ids[:-1] = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
                    lang.append(self.langs[NO_LANG.encode() if name is None else name])
                    parts.append(ids)
                    size += len(ids)
                    if size >= BLOCK:
                        yield from self.block(lang, parts)
                        lang, parts, size = [], [], 0
        if parts:
            yield from self.block(lang, parts)
        yield from self.finish()


class BucketCounter(PhraseCounter):
    """Occurrences of phrases by hash bucket, as runs (segment, run) of bucket numbers and their counts."""

    SCHEMA = "segment int, run binary"

    def clear(self) -> None:
        super().clear()
        self.held, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def count(self, langs: np.ndarray, ids: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _bucket(self.hashes(langs, ids, at, 0, self.n)).astype(np.int64)
        new, count = np.unique(found, return_counts=True)
        self.held, which = np.unique(np.concatenate([self.held, new]), return_inverse=True)
        weights = np.concatenate([self.counts, count])
        self.counts = np.bincount(which.reshape(-1), weights, len(self.held)).astype(np.int64)
        if len(self.held) > HELD_BUCKETS:
            yield from self.finish()

    def finish(self) -> Iterator[pa.RecordBatch]:
        segment = self.held // SEGMENT
        start = np.flatnonzero(np.diff(segment, prepend=-1))
        bounds = [*start.tolist(), len(segment)]
        runs = [
            zlib.compress((self.held[a:b] % SEGMENT).astype("<u2").tobytes() + self.counts[a:b].astype("<u4").tobytes(), 1)
            for a, b in zip(bounds, bounds[1:])
        ]
        if runs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment[start].astype(np.int32)), pa.array(runs, pa.binary())], names=["segment", "run"]
            )
        self.held, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U64(20)) & U64(BUCKETS - 1)


def _in_buckets(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bucket(h)
    return (bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1


def merge_buckets(least: int):
    """For runs sorted by segment: one row per segment, the bits of its buckets of at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = -1, np.zeros(SEGMENT, np.int64)

        def out():
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits])], names=["segment", "bits"])

        for batch in batches:
            for segment, blob in zip(batch.column("segment").to_pylist(), batch.column("run")):
                if segment != now:
                    if now >= 0:
                        yield out()
                    now, total = segment, np.zeros(SEGMENT, np.int64)
                raw = zlib.decompress(blob.as_py())
                n = len(raw) // 6
                # A run holds each bucket once.
                total[np.frombuffer(raw, "<u2", n)] += np.frombuffer(raw, "<u4", n, 2 * n)
        if now >= 0:
            yield out()

    return run


def _frequent_buckets(rows: DataFrame, n: int, sent, least: int) -> np.ndarray:
    """Bits of the buckets that hold at least ``least`` phrases of ``n`` words; at most BUCKETS / 8 bytes come here."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from BucketCounter(n, sent.value)(batches)

    runs = rows.mapInArrow(count, BucketCounter.SCHEMA).repartition("segment").sortWithinPartitions("segment")
    found = runs.mapInArrow(merge_buckets(least), "segment int, bits binary").toArrow()
    out = np.zeros(BUCKETS // 8, dtype=np.uint8)
    for segment, bits in zip(found["segment"].to_pylist(), found["bits"].to_pylist()):
        out[segment * SEGMENT // 8 : (segment + 1) * SEGMENT // 8] = np.frombuffer(bits, np.uint8)
    return out


def _filter_bits(frequent: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of (lang, phrase): set bits are combined by Spark, at most bits / 64 numbers come here."""

    def places(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key = name_hashes(batch.column("lang").to_pylist())
            words = [p.split(b" ") for p in batch.column("phrase").to_pylist()]
            for column in zip(*words):
                key = mix(key * _STEP + name_hashes(column))
            at = np.unique(np.concatenate(_places(key, bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> U64(6)).astype(np.int64)), pa.array((U64(1) << (at & U64(63))).view(np.int64))],
                names=["at", "bit"],
            )

    rows = frequent.select(F.col("lang").cast("binary").alias("lang"), F.col("phrase").cast("binary").alias("phrase"))
    found = rows.mapInArrow(places, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[found["at"].to_numpy()] = found["bit"].to_numpy()
    return out.view(U64)


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, bits: int = FILTER_BITS) -> DataFrame:
    """Every phrase of 1 to ``longest`` words with at least ``least`` occurrences:
    lang, phrase, words, f; the row with no words (empty phrase) holds a language's number of words."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("lang").cast("string").cast("binary").alias("lang"), text_bytes().alias("text"))
    found, sent = None, None
    for n in range(1, longest + 1):

        buckets = spark.sparkContext.broadcast(_frequent_buckets(rows, n, sent, least)) if n == 2 else None

        def count(batches, n=n, sent=sent, buckets=buckets):
            yield from PhraseCounter(n, *(None if x is None else x.value for x in (sent, buckets)))(batches)

        runs = rows.mapInArrow(count, PhraseCounter.SCHEMA)
        merged = (
            runs.repartition("part")
            .groupBy("lang", "part", "phrase")
            .agg(F.sum("f").alias("f"))
            .select("lang", "phrase", F.lit(n).alias("words"), "f")
        )
        if n == 1:
            merged = stage(merged, "phrases-words")
            totals = merged.groupBy("lang").agg(F.sum("f").alias("f"))
            found = totals.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("words"), "f")
        level = merged.where(F.col("f") >= least)
        if n > 1:
            level = stage(level, f"phrases-{n}")
        found = found.unionByName(level)
        if n < longest:
            sent = spark.sparkContext.broadcast(_filter_bits(level, bits))
    return found


def _big(column: str):
    return F.col(column).cast("decimal(18,0)")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, first: int = 2000) -> DataFrame:
    """Each language's first phrases by their lowest cut score: lang, rank, phrase, a, l, r, n, score."""
    f = frequent_phrases(docs, longest, least)
    totals = f.where("words = 0").select("lang", F.col("f").alias("n"))
    known = f.where("words > 0").select("lang", "phrase", "f")
    candidates = f.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    w = F.split("phrase", " ")

    # Candidates whose words lie inside a longer candidate that is as frequent.
    inside = (
        candidates.where("words > 2")
        .select(
            "lang", "a",
            F.explode(
                F.filter(
                    F.flatten(
                        F.transform(
                            F.sequence(F.lit(1), F.col("words") - 1),
                            lambda i: F.transform(
                                F.sequence(F.lit(2), F.col("words") - i + 1),
                                lambda m: F.array_join(F.slice(w, i, m), " "),
                            ),
                        )
                    ),
                    lambda p: p != F.col("phrase"),
                )
            ).alias("phrase"),
        )
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    left = (
        candidates.join(inside, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 100))
        .drop("longer")
    )
    cuts = left.select(
        "lang", "phrase", "a",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.col("words") - 1),
                lambda k: F.struct(
                    k.alias("k"),
                    F.array_join(F.slice(w, F.lit(1), k), " ").alias("head"),
                    F.array_join(F.slice(w, k + 1, F.col("words") - k), " ").alias("tail"),
                ),
            )
        ).alias("c"),
    ).select("lang", "phrase", "a", "c.*")
    scored = (
        cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("_over", F.lit(1000).cast("decimal(4,0)") * _big("a") * _big("n").cast("decimal(15,0)"))
        .withColumn("_under", _big("l") * _big("r"))
        .withColumn("score", F.expr("_over div _under"))
    )
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("m")
    ).select("lang", "phrase", "m.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of 64 parts of each language, so that no task ranks all of a hot one.
    of_part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    return (
        best.withColumn("rank", F.row_number().over(of_part))
        .where(F.col("rank") <= first)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= first)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
