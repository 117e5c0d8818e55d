"""N-gram Jaccard join: a prefix-tree join, and the groups its links form.

A document's set is its distinct word shingles (64-bit hashes of ``n`` words,
A-Z lower-cased; fewer words: the whole sequence as one). Equal sets are one
class, so copies are never compared.

1. Global order: rare shingles first. How often a shingle occurs is read from a
   sketch of ``CELLS`` counters over all documents (a fixed size, so every task
   can hold it at any scale); ties go by hash. Any fixed order gives the same
   links; this one keeps common passages out of the prefixes.
2. Two sets with Jaccard ``num/den`` or more share a shingle of their prefixes, the
   first ``size - ceil(size * num / den) + 1`` in order. Classes that share one, in
   the same range of sizes, form a block; blocks with the same members are one.
   Blocks beyond ``CHUNK`` members (of whole sets: or ``CHUNK_TOKENS`` tokens) are split, and
   pairs of chunks are dealt out.
3. In a block the ordered sets form a trie. It is walked depth first; the counts
   of shingles shared with every other member are kept per node and reused by
   all sets below it; a subtree whose counts plus remaining lengths cannot
   reach the threshold for any member is left out. This is done twice: over
   the prefixes alone (half hashes, so equal ones may be one too many, never one
   too few), which leaves groups of classes with a possible partner; then over
   the whole sets of each such group, which decides exactly. Whole texts travel
   for these classes only, once each.
4. Links, as stars of each block's groups, are joined into components by
   min-label rounds (large-star, small-star), each written to the shared folder.
5. In the exact pass every class also counts its links, each weighted by the other
   class's documents. Pairs inside one chunk are counted where the chunk meets itself,
   pairs of two chunks where these meet; so each pair counts once for either side, and
   no pair is written out.

Defined cases: without words or text a document has no set and links with
nothing; null ids rank last in a component and only give a null component if
no member has an id; repeated rows share a class; an empty table gives an
empty result; texts of any length are processed whole; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apiary.llm.common import fresh, join_groups, stage, text_bytes
from apiary.llm.words import BASE_WORD, U64, Words, batches_of_bytes, mix, run_hashes

SHINGLE = 3
NUM, DEN = 9, 10
CELL_BITS = 20
CELLS = 1 << CELL_BITS
# Members of a chunk, and words of its sets, at most (one larger set stands in a chunk of its kind).
CHUNK = 1024
CHUNK_TOKENS = 500_000
FEW = 16
STEP = 64
PART = 1 << 16


def _raw_shingles(texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle occurrence of a batch, and the range of each text's."""
    w = Words(texts, lower=True)
    h = w.hashes()
    words = np.diff(w.first)
    count = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(texts)), count)
    start = w.first[owner] + np.arange(len(owner)) - first[owner]
    end = np.minimum(start + n, w.first[owner + 1])
    return mix(run_hashes(h, start, end, BASE_WORD) + (end - start).astype(U64)), first


def shingle_sets(texts, n: int) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    h, first = _raw_shingles(texts, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        s = np.sort(h[a:b])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        yield s


def _cells(h: np.ndarray) -> np.ndarray:
    """Sketch cell of whole (64-bit) or half (32-bit) hashes: their leading bits."""
    return (h >> h.dtype.type(8 * h.dtype.itemsize - CELL_BITS)).astype(np.int64)


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counters of each part of the sketch, one batch at a time."""
    total: dict[int, np.ndarray] = {}
    unsqueeze = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for part, packed in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            counts = np.frombuffer(unsqueeze(packed), dtype=np.int64)
            total[part] = total[part] + counts if part in total else counts
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())], ["part", "packed"]
    )


def occurrences(docs: DataFrame, n: int, text_col: str) -> np.ndarray:
    """The sketch: rank of each cell by the occurrences of its shingles in all documents (CELLS numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in batches_of_bytes(texts):
                counts += np.bincount(_cells(_raw_shingles(texts[a:b], n)[0]), minlength=CELLS)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        parts = range(CELLS // PART)
        packed = [squeeze(counts[k * PART : (k + 1) * PART].tobytes()) for k in parts]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(packed, pa.binary())], ["part", "packed"])

    rows = docs.select(text_bytes(text_col).alias("_text")).mapInArrow(run, "part int, packed binary")
    found = rows.repartition(CELLS // PART, "part").mapInArrow(_add_parts, "part int, packed binary").collect()
    out = np.zeros(CELLS, dtype=np.int64)
    for part, packed in found:
        out[part * PART : (part + 1) * PART] = np.frombuffer(packed, dtype=np.int64)
    return np.unique(out, return_inverse=True)[1].astype(np.int32)


def ordered(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A sorted set in the global order."""
    return s[np.argsort(counts[_cells(s)], kind="stable")]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = [squeeze(t or b"") for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_hash"), pa.array(packed, pa.binary())], ["_id", "_hash", "_tokens"]
        )


def _describe(counts: np.ndarray, n: int, num: int, den: int):
    """Per document: class (hash of the set), size, prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in batches_of_bytes(texts):
                classes, sizes, prefixes = [], [], []
                for s in shingle_sets(texts[a:b], n):
                    size = len(s)
                    classes.append(int(mix(np.bitwise_xor.reduce(mix(s + U64(size)))[None]).view(np.int64)[0]) if size else None)
                    sizes.append(size)
                    # A set that no set of another size can reach links with equal sets only.
                    if size * den < (size + 1) * num and (size - 1) * den < size * num:
                        prefixes.append(np.zeros(0, np.int32))
                    else:
                        prefix = ordered(s, counts)[: size - -(-size * num // den) + 1]
                        prefixes.append((prefix >> U64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(a, b - a) for c in ("_row", "_id", "_hash")),
                        pa.array(classes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(prefixes, pa.list_(pa.int32())),
                    ],
                    ["_row", "_id", "_hash", "_class", "_size", "_prefix"],
                )

    return run


class Trie:
    """Ordered token sequences (whole sets, or their prefixes) of one block, walked as a trie."""

    def __init__(self, tokens: list[np.ndarray], sizes: np.ndarray, counts: np.ndarray, num: int, den: int):
        self.sizes, self.num, self.den = sizes, num, den
        flat = np.concatenate(tokens)
        distinct = np.unique(flat)
        by_order = np.argsort(counts[_cells(distinct)], kind="stable")
        rank = np.empty(len(distinct), dtype=np.int64)
        rank[by_order] = np.arange(len(distinct))
        ranks = rank[np.searchsorted(distinct, flat)]
        self.lengths = np.array([len(t) for t in tokens])
        edge = np.concatenate([[0], np.cumsum(self.lengths)])
        self.paths = [ranks[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        self.last = ranks[edge[1:] - 1]
        self.ranks, self.edge = ranks, edge
        # Which members hold a token.
        owner = np.repeat(np.arange(len(tokens)), self.lengths)
        o = np.argsort(ranks, kind="stable")
        self.members = owner[o]
        self.member_edge = np.searchsorted(ranks[o], np.arange(len(distinct) + 1))
        self.whole = bool((self.lengths == sizes).all())

    def _add(self, shared: np.ndarray, path: np.ndarray) -> np.ndarray:
        """Counts after a run of tokens."""
        parts = [self.members[a:b] for a, b in zip(self.member_edge[path].tolist(), self.member_edge[path + 1].tolist(), strict=True)]
        return shared + np.bincount(np.concatenate(parts), minlength=len(shared)) if parts else shared

    def _enough(self, shared: np.ndarray, size) -> np.ndarray:
        """Jaccard at or above the threshold, if ``shared`` tokens are shared."""
        return (self.num + self.den) * shared >= self.num * (size + self.sizes)

    def _walk(self, shared: np.ndarray, path: np.ndarray, begin: int, end: int, most: int, least: int, possible: np.ndarray, own):
        """Counts along ``path[begin:end]`` of a subtree (members ``own``) with sizes ``least`` to ``most``, and
        the members that can still reach the threshold with one of it; None once there is none but itself."""
        for a in range(begin, end, STEP):
            b = min(a + STEP, end)
            shared = self._add(shared, path[a:b])
            possible = possible & self._enough(shared + (most - b), least)
            # A lone set needs a partner outside of itself; sets of one subtree may link with each other.
            if not possible.any() or (len(own) == 1 and possible.sum() == possible[own[0]]):
                return None
        return shared, possible

    def _sizes_fit(self, sizes: np.ndarray, possible: np.ndarray, own) -> bool:
        """Whether two sets of the subtree, or one and a possible other, are near enough in size to link."""
        outside = possible.copy()
        outside[own] = False
        if outside.any():
            return True
        by_size = np.sort(sizes)
        return bool((by_size[:-1] * self.den >= by_size[1:] * self.num).any())

    def partners(self) -> Iterator[tuple[int, np.ndarray]]:
        """(member, members it may link with); exact for whole sets. Pairs can come from either side."""
        n = len(self.paths)
        order = sorted(range(n), key=lambda i: self.paths[i].tolist())
        common = [0] * (n + 1)
        for k in range(1, n):
            x, y = self.paths[order[k - 1]], self.paths[order[k]]
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            common[k] = int(differ[0]) if len(differ) else m
        stack = [(0, np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool))]
        k = 0
        while k < n:
            i = order[k]
            while stack[-1][0] > common[k]:
                stack.pop()
            depth, shared, possible = stack[-1]
            if common[k + 1] > depth:
                # A node that several sets share: its counts are worked out once.
                node, below = common[k + 1], k + 1
                while common[below + 1] >= node:
                    below += 1
                own = order[k : below + 1]
                sizes = self.sizes[own]
                walked = self._walk(shared, self.paths[i], depth, node, int(sizes.max()), int(sizes.min()), possible, own)
                if walked is None or not self._sizes_fit(sizes, walked[1], own):
                    k = below + 1
                    continue
                shared, possible = walked
                stack.append((node, shared, possible))
                depth = node
            size = int(self.sizes[i])
            walked = self._walk(shared, self.paths[i], depth, len(self.paths[i]), size, size, possible, [i])
            if walked is not None:
                shared, possible = walked
                found = possible & self._enough(shared + self._rest(i), size)
                found[i] = False
                if found.any():
                    yield i, np.flatnonzero(found)
            k += 1

    def _rest(self, i: int):
        """Most tokens that can be shared beyond the paths' known part."""
        if self.whole:
            return 0
        upto = np.minimum(self.last, self.last[i])
        known_i = np.searchsorted(self.paths[i], upto, side="right")
        held = np.concatenate([[0], np.cumsum(self.ranks <= self.last[i])])
        known = held[self.edge[1:]] - held[self.edge[:-1]]
        return np.minimum(self.sizes[i] - known_i, self.sizes - known)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows sorted by block, one table per block; a block may span batches."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("_block", "_ci", "_cj")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(keys[a].tolist())
            if key is not None and now != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _tokens(column: pa.ChunkedArray, counts: np.ndarray, n: int) -> list[np.ndarray]:
    """Prefixes (lists of half hashes), or the whole ordered sets of packed texts."""
    column = column.combine_chunks()
    if pa.types.is_binary(column.type):
        unsqueeze = zstandard.ZstdDecompressor().decompress
        return [ordered(s, counts) for s in shingle_sets([unsqueeze(t) for t in column.to_pylist()], n)]
    flat = column.flatten().to_numpy().view(np.uint32)
    edge = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
    return [flat[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _join_blocks(counts: np.ndarray, n: int, num: int, den: int, exact: bool):
    """Links of each block, as stars: every linked class with one of its group.

    ``exact``: also rows without ``_with``, with the documents that a class's links in this block lead to.
    """
    names = ["_class", "_with", "_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, links = [], [], []
        for (_, ci, cj), rows in _blocks(batches):
            sizes = rows["_size"].to_numpy()
            # Sizes alone rule out most chance meetings of two.
            if len(sizes) < 2 or (len(sizes) == 2 and sizes.min() * den < sizes.max() * num):
                continue
            classes = rows["_class"].to_numpy()
            label = np.arange(len(classes))
            if exact:
                copies, chunk = rows["_n"].to_numpy(), rows["_c"].to_numpy()
            for i, found in Trie(_tokens(rows["_tokens"], counts, n), sizes, counts, num, den).partners():
                merge = np.unique(label[np.append(found, i)])
                if len(merge) > 1:
                    label[np.isin(label, merge)] = merge[0]
                if exact:
                    # Pairs inside a chunk are counted in the block (c, c) alone.
                    counted = found if ci == cj else found[chunk[found] != chunk[i]]
                    left.append(int(classes[i]))
                    right.append(None)
                    links.append(int(copies[counted].sum()))
            linked = np.flatnonzero(label != np.arange(len(classes)))
            left += classes[linked].tolist()
            right += classes[label[linked]].tolist()
            links += [None] * len(linked)
            if len(left) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (left, right, links)], names)
                left, right, links = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (left, right, links)], names)

    return run


def _deal(members: DataFrame, tokens: DataFrame, counts: np.ndarray, n: int, num: int, den: int, exact: bool = False) -> DataFrame:
    """Join each block's members to their tokens, split large blocks, run the trie join: (_class, _with, _links)."""
    also = ["_c", "_n"] if exact else []
    sized = members.groupBy("_block").agg(F.count("*").alias("_members")).where("_members > 1")
    chunks = F.ceil(F.col("_members") / CHUNK)
    if exact:
        # Whole sets are counted by their tokens as well; blocks of few members are never split.
        heavy = (
            members.join(sized.where(F.col("_members") > FEW), "_block")
            .join(tokens.select("_class", F.col("_size").alias("_width")), "_class")
            .groupBy("_block")
            .agg(F.sum("_width").alias("_width"))
        )
        sized = sized.join(heavy, "_block", "left")
        chunks = F.greatest(chunks, F.ceil(F.coalesce("_width", F.lit(0)) / CHUNK_TOKENS))
    sized = sized.withColumn("_chunks", F.least(chunks, F.col("_members")).cast("long"))
    rows = members.join(sized.select("_block", "_chunks"), "_block")
    rows = rows.withColumn("_c", F.pmod(F.xxhash64("_class"), F.col("_chunks")))
    # A member of chunk c meets chunks i <= c as the second and j >= c as the first.
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1),
        lambda k: F.struct(F.least(k, F.col("_c")).alias("_ci"), F.greatest(k, F.col("_c")).alias("_cj")),
    )
    rows = rows.select("_block", "_class", "_c", F.explode(pair).alias("_p")).select("_block", "_class", "_c", "_p._ci", "_p._cj")
    rows = rows.join(tokens, "_class")
    return (
        rows.repartition("_block", "_ci", "_cj")
        .sortWithinPartitions("_block", "_ci", "_cj", "_class")
        .select("_block", "_ci", "_cj", "_class", "_size", "_tokens", *also)
        .mapInArrow(_join_blocks(counts, n, num, den, exact), "_class long, _with long, _links long")
    )


def _same_members_once(members: DataFrame) -> DataFrame:
    """(_block, _class): of blocks with the same members one is left, under a new number."""
    marks = members.groupBy("_block").agg(
        F.count("*").alias("_n"),
        F.bit_xor(F.xxhash64("_class")).alias("_x"),
        F.sum(F.xxhash64("_class", F.lit(1)).cast("decimal(38,0)")).alias("_y"),
    )
    once = marks.where("_n > 1").groupBy("_n", "_x", "_y").agg(F.min("_block").alias("_block")).select("_block")
    return members.join(once, "_block")


def components(links: DataFrame) -> DataFrame:
    """(_class, _top): the smallest class of each linked class's component.

    Large-star and small-star in turn until nothing changes; every round is written to the shared folder.
    """
    edges = stage(links.selectExpr("greatest(_class, _with) as u", "least(_class, _with) as v").distinct(), "links")
    while True:
        # Large star: neighbours above u go to the smallest of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: neighbours below u, and u itself, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        after = stage(small.where("u <> v").distinct(), "links")
        # Done when the edges are stars: no smaller end is itself above another.
        if after.select(F.col("v").alias("u")).join(after.select("u"), "u", "left_semi").isEmpty() and (
            after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        ):
            return after.select(F.col("u").alias("_class"), F.col("v").alias("_top"))
        edges = after


def jaccard_groups(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """(_row, _id, n_shingles, component_id, _keep_row, class_id, n_links) for every row of ``docs``: links
    join documents whose sets have a Jaccard similarity of ``num/den`` or more; ``_keep_row`` is the row of
    the component's smallest id; ``class_id`` is the smallest id of the documents with the same set;
    ``n_links`` counts the other rows that a row is linked with, those with the same set included."""
    counts = occurrences(docs, shingle, text_col)
    source = docs.select(
        (row if row is not None else F.monotonically_increasing_id()).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(text_bytes(text_col)).alias("_hash"),
        text_bytes(text_col).alias("_text"),
    )
    described = stage(
        source.mapInArrow(
            _describe(counts, shingle, num, den),
            "_row long, _id long, _hash long, _class long, _size long, _prefix array<int>",
        ),
        "sets",
    )
    first = F.struct(F.col("_id").isNull(), "_id", "_row", "_hash")
    classes = stage(
        described.where("_class is not null")
        .groupBy("_class")
        .agg(F.count("*").alias("_n"), F.min(first).alias("_first"), F.max("_size").alias("_size"), F.first("_prefix").alias("_prefix")),
        "classes",
    )
    # Tokens that two classes share, by range of sizes: a class meets its own range and the next.
    tokens = classes.select(F.explode("_prefix").alias("_token"), "_class")
    shared = tokens.groupBy("_token").agg(F.count("*").alias("_n")).where("_n > 1").select("_token")
    span = F.floor(F.log(F.col("_size").cast("double")) / F.log(F.lit(den / num)) + 1e-9)
    placed = tokens.join(shared, "_token").join(classes.select("_class", "_size"), "_class").select(
        "_class", F.explode(F.array(F.xxhash64("_token", span), F.xxhash64("_token", span + 1))).alias("_block")
    )
    members = stage(_same_members_once(stage(placed.distinct(), "blocks")), "members")
    prefixes = classes.select("_class", "_size", F.col("_prefix").alias("_tokens"))
    possible = components(_deal(members, prefixes, counts, shingle, num, den))
    members = stage(
        possible.select(F.col("_top").alias("_block"), "_class").unionByName(
            possible.select(F.col("_top").alias("_block"), F.col("_top").alias("_class")).distinct()
        ),
        "possible",
    )
    # One document's text for each class that may link.
    chosen = classes.join(members.select("_class"), "_class").select(
        "_class", "_size", "_n", F.col("_first._id").alias("_cid"), F.col("_first._hash").alias("_chash")
    )
    packed = source.select("_id", "_hash", "_text").mapInArrow(_pack, "_id long, _hash long, _tokens binary")
    sets = packed.join(chosen, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_hash") == F.col("_chash"))).select(
        "_class", "_size", "_n", "_tokens"
    )
    sets = stage(sets.dropDuplicates(["_class"]), "texts")
    joined = stage(_deal(members, sets, counts, shingle, num, den, exact=True), "joined")
    tops = components(joined.where("_with is not null"))
    links = joined.where("_with is null").groupBy("_class").agg(F.sum("_links").alias("_links"))
    # Every class with its component's smallest id; classes without links are their own component.
    top = classes.select("_class", "_n", "_first").join(tops, "_class", "left").withColumn("_top", F.coalesce("_top", "_class"))
    best = top.groupBy("_top").agg(F.min("_first").alias("_best"))
    groups = stage(
        top.join(best, "_top").join(links, "_class", "left").select(
            "_class",
            "_n",
            F.col("_best._id").alias("component_id"),
            F.col("_best._row").alias("_keep_row"),
            F.col("_first._id").alias("class_id"),
            (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).alias("n_links"),
        ),
        "components",
    )
    rows = described.select("_row", "_id", "_class", F.col("_size").alias("n_shingles"))
    alone = rows.where("_class is null").select(
        "_row",
        "_id",
        "n_shingles",
        F.col("_id").alias("component_id"),
        F.col("_row").alias("_keep_row"),
        F.col("_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
    )
    linked = rows.where("_class is not null")
    return join_groups(linked, groups, ["_class"], "_n", linked.count()).select(
        "_row", "_id", "n_shingles", "component_id", "_keep_row", "class_id", "n_links"
    ).unionByName(alone)


def keep_one(docs: DataFrame, shingle: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays, unchanged."""
    row = fresh("row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "near-docs")
    groups = jaccard_groups(numbered, shingle, num, den, id_col, text_col, row=F.col(row))
    stays = groups.where(F.col("_row") == F.col("_keep_row")).select(F.col("_row").alias(row))
    return numbered.join(stays, row, "left_semi").drop(row)
