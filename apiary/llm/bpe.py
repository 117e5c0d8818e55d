"""Byte-level BPE encoding and decoding: speculate and verify.

A text is cut into pieces by the tokenizer's split rule. For each distinct
piece of a batch, a greedy longest match proposes tokens. The proposal is the
exact BPE result if every adjacent pair of its tokens is compatible: merging
the pair's bytes alone gives back the pair. All adjacent pairs of all new
pieces are tested at once with numpy (:meth:`Bpe.compatible`). Only pieces with
a failing pair are merged exactly, by rank, with a heap.

Why pairs suffice: BPE applies merges in rank order. A token that BPE makes
somewhere covers its own bytes by merges of that token's tree alone, so a
merge that crosses a border between two proposed tokens joins a node of the
right spine of one with a node of the left spine of the next: it depends on
that pair only. It happens if it is ranked below the merge that consumes its
left half, and not above the one that consumes its right half (equal merges go
left to right). If no border is crossed, every token forms by itself.

Results equal the tokenizers library's ``encode(text,
add_special_tokens=False)`` and ``decode(ids, skip_special_tokens=False)``:
an added token's string in a text becomes that token.

Defined cases: a null text counts as empty (no tokens); an empty table gives an
empty result; repeated rows and ids each give a row; texts of any length are
processed whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.llm.common import small_batches, text_bytes
from apiary.llm.words import NEVER, hash_runs, lookup

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below U+0530 the installed regex module and the tokenizers library class every character alike.
_LATER = regex.compile("[\u0530-\U0010ffff]")
# Distinct pieces remembered per task before the memory is cleared.
REMEMBERED = 1_000_000
# Failing pieces of at most this many bytes are merged side by side in numpy, longer ones one by one.
SIDE_BY_SIDE = 64
_BLANK, _SPACE, _LETTER, _NUMBER, _OTHER = range(5)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Bpe:
    """A byte-level BPE vocabulary (tokenizers JSON file), ready for speculation."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        raw = {t: bytes(alphabet[c] for c in t) for t in vocab}
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token = [b""] * size
        for t, i in vocab.items():
            self.token[i] = raw[t]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_bytes = [content.encode() for content in self.added]
        for content, i in self.added.items():
            self.token[i] = content.encode()
        self.byte_id = {raw[t]: i for t, i in vocab.items() if len(raw[t]) == 1}

        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        rank = np.arange(len(merges), dtype=np.int64)
        self.merge = {}
        for x, y, m, r in zip(left.tolist(), right.tolist(), made.tolist(), rank.tolist(), strict=True):
            self.merge.setdefault((x, y), (r, m))
        # Per token: its two halves and the rank of the merge that makes it (-1: a single byte).
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        self.left[made[::-1]], self.right[made[::-1]], self.rank[made[::-1]] = left[::-1], right[::-1], rank[::-1]
        # Merge rank by pair, for lookups of many pairs at once.
        self._size = size
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self._pair, self._pair_rank = key[order], rank[order]

        # A token can be proposed if BPE of its own bytes gives it back.
        sound = self.compatible(self.left[made], self.right[made], self.rank[made])
        good = np.zeros(size, dtype=bool)
        good[list(self.byte_id.values())] = True
        for i, ok, x, y in zip(made.tolist(), sound.tolist(), left.tolist(), right.tolist(), strict=True):
            good[i] |= ok and good[x] and good[y]
        # Trie of the tokens that can be proposed: node and byte to node, node to token.
        child: dict[int, int] = {}
        token_at = [-1]
        for i in vocab.values():
            if good[i]:
                node = 0
                for c in self.token[i]:
                    node = child.setdefault(node << 8 | c, len(token_at))
                    if node == len(token_at):
                        token_at.append(-1)
                token_at[node] = i
        edges = np.array(sorted(child), dtype=np.int64)
        self._edges, self._children = edges, np.array([child[k] for k in edges.tolist()], dtype=np.int64)
        self._token_at = np.array(token_at, dtype=np.int64)
        self._byte_ids = np.array([self.byte_id[bytes((c,))] for c in range(256)], dtype=np.int64)
        self._rank_made = made
        self.split = regex.compile(SPLIT)
        self._cut_added = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self._library = None
        self._path = path

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return lookup(self._pair, self._pair_rank, a * self._size + b, NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair: no merge crosses the border between ``a`` and ``b`` (before rank ``before``)."""
        x, y = a.copy(), b.copy()
        until_x = np.full(len(x), NEVER, np.int64) if before is None else before.copy()
        until_y = until_x.copy() if before is None else before - 1
        ok = np.ones(len(x), dtype=bool)
        live = np.arange(len(x))
        while len(live):
            u, v = x[live], y[live]
            r = self._ranks(u, v)
            crossed = (r != NEVER) & (r < until_x[live]) & (r <= until_y[live])
            ok[live[crossed]] = False
            # Go back in time: undo whichever half was made later.
            ru, rv = self.rank[u], self.rank[v]
            go = ~crossed & ((ru >= 0) | (rv >= 0))
            # Equal ranks: the left one was made first, so undo the right one.
            undo_x = go & (ru > rv)
            undo_y = go & ~undo_x
            i = live[undo_x]
            until_x[i], x[i] = ru[undo_x], self.right[u[undo_x]]
            i = live[undo_y]
            until_y[i], y[i] = rv[undo_y], self.left[v[undo_y]]
            live = live[go]
        return ok

    def propose(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of every piece ``data[start:end]``, all pieces in step.

        Returns the tokens in order and the number of the piece of each.
        """
        at, pos = start.copy(), start.copy()
        node, best, best_end = np.zeros((3, len(start)), dtype=np.int64)
        live = np.flatnonzero(start < end)
        what, whose = [], []
        while len(live):
            p = pos[live]
            open_ = p < end[live]
            key = node[live] << 8 | data[np.where(open_, p, 0)]
            to = np.where(open_, lookup(self._edges, self._children, key, -1), -1)
            on = to >= 0
            i = live[on]
            node[i] = to[on]
            pos[i] += 1
            token = self._token_at[to[on]]
            hit = token >= 0
            best[i[hit]], best_end[i[hit]] = token[hit], pos[i[hit]]
            # Every single byte is a token, so a match that ends has found one.
            i = live[~on]
            what.append(best[i])
            whose.append(i)
            at[i] = pos[i] = best_end[i]
            node[i] = 0
            live = live[on | (best_end[live] < end[live])]
        if not what:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Pieces may be given in any order; each round adds a token to the end of its piece.
        whose = np.concatenate(whose)
        order = np.argsort(whose, kind="stable")
        return np.concatenate(what)[order], whose[order]

    def merge_side_by_side(self, data: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of pieces of one length: in each round every piece merges its best pair."""
        n = len(start)
        ids = self._byte_ids[data[start[:, None] + np.arange(length)]]
        count = np.full(n, length)
        rank = self._ranks(ids[:, :-1], ids[:, 1:]) if length > 1 else np.full((n, 0), NEVER)
        live = np.arange(n)
        columns = np.arange(length)
        while length > 1 and len(live):
            m = rank[live].argmin(axis=1)
            r = rank[live, m]
            go = r != NEVER
            live, m, r = live[go], m[go], r[go]
            if not len(live):
                break
            moved = np.minimum(columns + (columns > m[:, None]), length - 1)
            row = np.take_along_axis(ids[live], moved, axis=1)
            row[np.arange(len(live)), m] = self._rank_made[r]
            moved = np.minimum(columns[:-1] + (columns[:-1] >= m[:, None]), length - 2)
            ranks = np.take_along_axis(rank[live], moved, axis=1)
            count[live] -= 1
            left = count[live]
            # The two pairs that changed; pairs past the end have no rank.
            for k in (m - 1, m):
                ok = (k >= 0) & (k + 1 < left)
                rows = np.flatnonzero(ok)
                ranks[rows, k[ok]] = self._ranks(row[rows, k[ok]], row[rows, k[ok] + 1])
            ranks[columns[:-1] >= left[:, None] - 1] = NEVER
            ids[live], rank[live] = row, ranks
        keep = columns < count[:, None]
        return ids[keep], count

    def merge_exactly(self, piece: bytes) -> list[int]:
        """Rank-ordered merging with a heap over a linked list."""
        ids = [self.byte_id[bytes((b,))] for b in piece]
        n = len(ids)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.merge[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merge]
        heapq.heapify(heap)
        while heap:
            r, made, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or self.merge.get((ids[i], ids[j])) != (r, made):
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                prior[k] = i
                if m := self.merge.get((made, ids[k])):
                    heapq.heappush(heap, (*m, i))
            h = prior[i]
            if h >= 0 and (m := self.merge.get((ids[h], made))):
                heapq.heappush(heap, (*m, h))
        return [i for i in ids if i >= 0]

    def encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every piece, and the number of tokens of each: speculate, verify
        all adjacent pairs at once, merge the failing pieces exactly."""
        flat, owner = self.propose(data, start, end)
        count = np.bincount(owner, minlength=len(start))
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        if not len(inner):
            return flat, count
        pairs, where = np.unique(flat[inner] * self._size + flat[inner + 1], return_inverse=True)
        bad = ~self.compatible(pairs // self._size, pairs % self._size)[where]
        failing = np.unique(owner[inner[bad]])
        if not len(failing):
            return flat, count
        fails = np.zeros(len(start), dtype=bool)
        fails[failing] = True
        tokens, whose = [flat[~fails[owner]]], [owner[~fails[owner]]]
        length = end[failing] - start[failing]
        for n in np.unique(length).tolist():
            group = failing[length == n]
            if n <= SIDE_BY_SIDE:
                got, counts = self.merge_side_by_side(data, start[group], n)
                tokens.append(got)
                whose.append(np.repeat(group, counts))
            else:
                for k in group.tolist():
                    got = self.merge_exactly(data[start[k] : end[k]].tobytes())
                    tokens.append(np.array(got, dtype=np.int64))
                    whose.append(np.full(len(got), k))
        owner = np.concatenate(whose)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], np.bincount(owner, minlength=len(start))

    def pieces(self, text: str) -> list[str]:
        if _LATER.search(text) is None:
            return self.split.findall(text)
        # Other characters: the library's own split, whose Unicode tables differ from regex's.
        return [text[a:b] for _, (a, b) in self.library().pre_tokenize_str(text)]

    def library(self):
        """The library's splitter of this vocabulary."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path).pre_tokenizer
        return self._library

    def parts(self, text: str) -> list[str]:
        """Pieces of a text; an added token's string is a piece of its own."""
        if self._cut_added is None or self._cut_added.search(text) is None:
            return self.pieces(text)
        out, at = [], 0
        for m in self._cut_added.finditer(text):
            out += self.pieces(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.pieces(text[at:])

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The vocabulary, read once per Python process."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


class Characters:
    """Class of every character in the split rule, by Unicode number. Below U+0530 the installed regex module and
    the library agree; the library itself is asked for others, once for each that is met in a process."""

    def __init__(self) -> None:
        self.kind = np.full(0x110000, -1, dtype=np.int8)
        self.kind[:0x530] = _OTHER
        for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_BLANK, r"\s")):
            one = regex.compile(pattern)
            self.kind[[c for c in range(0x530) if one.match(chr(c))]] = kind
        self.kind[0x20] = _SPACE

    def learn(self, codes: np.ndarray, pre_tokenizer) -> None:
        for c in np.unique(codes[self.kind[codes] < 0]).tolist():
            # A character joins a piece of its own class only.
            found = [k for k, before in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")) if self._joins(pre_tokenizer, before + chr(c))]
            self.kind[c] = found[0] if found else _BLANK

    @staticmethod
    def _joins(pre_tokenizer, text: str) -> bool:
        return len(pre_tokenizer.pre_tokenize_str(text)) == 1


CHARACTERS = Characters()


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of valid UTF-8: the number of its character, and where that begins."""
    begins = (data & 0xC0) != 0x80
    lead = np.flatnonzero(begins)
    first = data[lead].astype(np.int32)
    code = first.copy()
    high = np.flatnonzero(first >= 0xC0)
    at, head = lead[high], first[high]
    tail = np.zeros((3, len(high)), dtype=np.int32)
    length = 1 + (head >= 0xE0).astype(np.int8) + (head >= 0xF0)
    for k in range(3):
        has = length > k
        tail[k, has] = data[at[has] + k + 1] & 0x3F
    code[high] = np.where(
        length == 1,
        (head & 0x1F) << 6 | tail[0],
        np.where(
            length == 2,
            (head & 0x0F) << 12 | tail[0] << 6 | tail[1],
            (head & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2],
        ),
    )
    owner = np.cumsum(begins) - 1
    return code[owner], lead[owner]


def split_points(data: np.ndarray, first: np.ndarray, pre_tokenizer=None) -> np.ndarray:
    """Byte offsets at which pieces start, by the rule of SPLIT, for the texts that
    start at ``first`` (every text has a byte or more, valid UTF-8)."""
    n = len(data)
    if (data >= 0x80).any():
        code, start_of = code_points(data)
        if (CHARACTERS.kind[code] < 0).any():
            CHARACTERS.learn(code, pre_tokenizer)
    else:
        code = start_of = None
    kind = CHARACTERS.kind[data if code is None else code]
    blank = kind <= _SPACE
    group = np.where(blank, _BLANK, kind)
    begins = np.ones(n, dtype=bool)
    begins[1:] = group[1:] != group[:-1]
    begins[first] = True
    run = np.flatnonzero(begins)
    text_begins = np.zeros(n + 1, dtype=bool)
    text_begins[first] = True
    text_begins[n] = True
    starts = begins.copy()
    # Blank runs that another run of the same text follows: their last character stands apart,
    # and a space there belongs to the following piece.
    run_end = np.append(run[1:], n)
    followed = blank[run] & ~text_begins[run_end]
    after = run_end[followed]
    last = after - 1
    if start_of is not None:
        last = start_of[last]
    starts[last] = True
    starts[after[kind[last] == _SPACE]] = False
    # Contractions: an apostrophe that starts a piece, with letters right after it.
    quote = run[(data[run] == 0x27) & (run_end - run == 1)]
    quote = quote[starts[quote]]
    quote = quote[~text_begins[quote + 1]]
    quote = quote[kind[quote + 1] == _LETTER]
    if len(quote):
        a = data[quote + 1]
        b = np.where(quote + 2 < n, data[np.minimum(quote + 2, n - 1)], 0)
        b = np.where(text_begins[np.minimum(quote + 2, n)], 0, b)
        one = np.isin(a, np.frombuffer(b"stmd", dtype=np.uint8))
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for taken, chosen in ((1, one), (2, two)):
            q = quote[chosen]
            starts[q + 1] = False
            q = q + 1 + taken
            starts[q[q < n]] |= ~blank[q[q < n]] | begins[q[q < n]]
    return np.flatnonzero(starts)


class Encoder:
    """Encodes batches of texts; pieces met before are looked up by hash, in bounded memory."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self._forget()

    def _forget(self) -> None:
        self._hash = np.zeros(0, dtype=np.uint64)
        self._at, self._count, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, data, start, end, hashes) -> None:
        ids, count = self.bpe.encode_pieces(data, start, end)
        at = np.cumsum(count) - count + len(self._ids)
        self._ids = np.concatenate([self._ids, ids.astype(np.int32)])
        merged = np.concatenate([self._hash, hashes])
        order = np.argsort(merged, kind="stable")
        self._hash = merged[order]
        self._at = np.concatenate([self._at, at])[order]
        self._count = np.concatenate([self._count, count])[order]

    def _pieces(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces in order, and the number of tokens of each."""
        distinct, sample, which = np.unique(hash_runs(data, start, end), return_index=True, return_inverse=True)
        if len(self._hash) > REMEMBERED:
            self._forget()
        place = lookup(self._hash, np.arange(len(self._hash)), distinct, -1)
        new = place < 0
        if new.any():
            self._learn(data, start[sample[new]], end[sample[new]], distinct[new])
            place = lookup(self._hash, np.arange(len(self._hash)), distinct, -1)
        place = place[which]
        count = self._count[place]
        total = np.cumsum(count)
        index = np.arange(total[-1] if len(total) else 0) + np.repeat(self._at[place] - total + count, count)
        return self._ids[index], count

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text; ``self.decoded`` then holds what they decode to, in bytes."""
        out: list[np.ndarray | None] = [np.zeros(0, np.int32)] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and self._is_plain(t)]
        if plain:
            data = np.frombuffer(b"".join(texts[i] for i in plain), dtype=np.uint8)
            edge = np.cumsum([0, *(len(texts[i]) for i in plain)])
            start = split_points(data, edge[:-1], self.bpe.library())
            end = np.append(start[1:], len(data))
            ids, count = self._pieces(data, start, end)
            upto = np.append(0, np.cumsum(count))[np.searchsorted(start, edge)]
            for k, i in enumerate(plain):
                out[i] = ids[upto[k] : upto[k + 1]]
        self._encode_others(texts, sorted({i for i, t in enumerate(texts) if t}.difference(plain)), out)
        self.decoded = [b""] * len(texts)
        for i, t in enumerate(texts):
            self.decoded[i] = self.bpe.decode_bytes(out[i].tolist())
            # A text whose pieces' hashes misled.
            if t and self.decoded[i] != t:
                out[i] = self._encode_one(t)
                self.decoded[i] = self.bpe.decode_bytes(out[i].tolist())
        return out

    def _encode_others(self, texts: list[bytes], which: list[int], out: list) -> None:
        """Texts with added tokens: all their pieces at once, through the same memory."""
        if not which:
            return
        added = self.bpe.added
        parts = [self.bpe.parts(texts[i].decode("utf-8", "replace")) for i in which]
        raw = [p.encode() for part in parts for p in part if p not in added]
        edge = np.cumsum([0, *map(len, raw)])
        ids, count = self._pieces(np.frombuffer(b"".join(raw) or b" ", dtype=np.uint8), edge[:-1], edge[1:])
        upto = np.append(0, np.cumsum(count))
        at = 0
        for i, part in zip(which, parts, strict=True):
            found, begin = [], at
            for p in part:
                if p in added:
                    found += [ids[upto[begin] : upto[at]], np.array([added[p]], dtype=np.int32)]
                    begin = at
                else:
                    at += 1
            out[i] = np.concatenate([*found, ids[upto[begin] : upto[at]]]).astype(np.int32)

    def _is_plain(self, text: bytes) -> bool:
        return not any(a in text for a in self.bpe.added_bytes)

    def _encode_one(self, text: bytes) -> np.ndarray:
        out = []
        for piece in self.bpe.parts(text.decode("utf-8", "replace")):
            if piece in self.bpe.added:
                out.append(np.array([self.bpe.added[piece]], dtype=np.int32))
            else:
                raw = np.frombuffer(piece.encode(), dtype=np.uint8)
                out.append(self.bpe.encode_pieces(raw, np.array([0]), np.array([len(raw)]))[0].astype(np.int32))
        return np.concatenate(out) if out else np.zeros(0, np.int32)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    """UTF-8 texts; null counts as empty, bytes that are no UTF-8 become U+FFFD."""
    out = [t or b"" for t in batch.column("_text").to_pylist()]
    return [t if t.isascii() else t.decode("utf-8", "replace").encode() for t in out]


def _groups(texts: list[bytes], limit: int = 2_000_000) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(path))
        for batch in batches:
            at = 0
            for group in _groups(_texts(batch)):
                ids = encoder.encode(group)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(at, len(group)), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )
                at += len(group)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``text``: the ids decoded (null ids: null); bytes that are no UTF-8 become U+FFFD."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [
                None if ids is None else bpe.decode_bytes(ids).decode("utf-8", "replace")
                for ids in batch.column(ids_col).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): :func:`encode` and :func:`decode` in one pass, one vocabulary a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(path))
        for batch in batches:
            at = 0
            for group in _groups(_texts(batch)):
                ids = encoder.encode(group)
                texts = [t.decode("utf-8", "replace") for t in encoder.decoded]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(at, len(group)), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "text"],
                )
                at += len(group)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_text")).mapInArrow(
        run, "doc_id long, ids array<int>, text string"
    )


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        encoder = Encoder(bpe)
        decimal = [str(i) for i in range(len(bpe.token))]
        for batch in batches:
            n_tokens, ids_sha, decoded_sha = [], [], []
            for group in _groups(_texts(batch)):
                encoded = encoder.encode(group)
                for ids, decoded in zip(map(np.ndarray.tolist, encoded), encoder.decoded, strict=True):
                    n_tokens.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def default_path() -> str:
    """Place of the public vocabulary file."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path("byte_bpe_50k.json"))
