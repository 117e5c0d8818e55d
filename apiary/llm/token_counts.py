"""Token counts: linear longest match without building pieces.

The vocabulary is a trie over bytes. Each node has a failure link, to the node
reached after the longest-match pieces that end inside it are taken off, and
the number of those pieces (its popped-token count), worked out once when the
vocabulary is loaded. A word is read byte by byte, never backwards: where the
trie has no edge, the node's popped count is added and its failure link
followed. The sum is the number of greedy longest-match pieces of the word.

A word is a run of bytes other than ASCII white space, read with a marker
before it (a space by default, as byte-level vocabularies write word starts).
All distinct words of a batch step together in numpy; counts of words met
before are kept, in bounded memory.

Defined cases: a null or empty text has 0 words and 0 tokens; a word that the
vocabulary cannot cover counts as one (unknown) token; an empty table gives an
empty result; repeated rows each give a row; other columns are not read.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.llm.bpe import byte_alphabet
from apiary.llm.common import text_bytes
from apiary.llm.words import Words, batches_of_bytes, lookup

# Distinct words remembered per task before the memory is cleared.
REMEMBERED = 1_000_000


class PieceAutomaton:
    """Trie with failure links and popped-token counts over a set of pieces."""

    def __init__(self, pieces: Iterable[bytes], marker: bytes = b" "):
        self.marker = marker
        child: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                nxt = child[node].get(c)
                if nxt is None:
                    nxt = child[node][c] = len(child)
                    child.append({})
                    final.append(False)
                node = nxt
            final[node] = bool(node)
        # Breadth first: a node's link follows from its parent's.
        fail, popped = [-1] * len(child), [0] * len(child)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for c, node in child[parent].items():
                todo.append(node)
                if final[node]:
                    fail[node], popped[node] = 0, 1
                    continue
                z, n = fail[parent], popped[parent]
                while z >= 0 and c not in child[z]:
                    n += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[node], popped[node] = child[z][c], n
        edges = sorted((node << 8 | c, to) for node, out in enumerate(child) for c, to in out.items())
        self._edges = np.array([e for e, _ in edges], dtype=np.int64)
        self._to = np.array([t for _, t in edges], dtype=np.int64)
        self._fail, self._popped = np.array(fail, dtype=np.int64), np.array(popped, dtype=np.int64)

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of pieces of each word ``data[start:end]``, marker included."""
        total = np.zeros(len(start), dtype=np.int64)
        node = np.zeros(len(start), dtype=np.int64)
        pos = start - len(self.marker)
        marker = np.frombuffer(self.marker or b"\0", dtype=np.uint8)
        live = np.arange(len(start))
        while len(live):
            p = pos[live]
            more = p < end[live]
            back = p - start[live]
            byte = np.where(back < 0, marker[np.clip(back, -len(marker), -1)], data[np.clip(p, 0, len(data) - 1)])
            to = np.where(more, lookup(self._edges, self._to, node[live] << 8 | byte, -1), -1)
            on = to >= 0
            i = live[on]
            node[i] = to[on]
            pos[i] += 1
            # No edge, or the word's end: take off the pieces that are complete.
            done = ~more & (node[live] == 0)
            pop = ~on & ~done
            i = live[pop]
            total[i] += self._popped[node[i]]
            node[i] = self._fail[node[i]]
            unknown = np.zeros(len(live), dtype=bool)
            unknown[pop] = node[i] < 0
            total[live[unknown]] = 1
            live = live[~done & ~unknown]
        return total


def byte_level_pieces(path: str) -> list[bytes]:
    """Byte strings of a byte-level vocabulary (tokenizers JSON file)."""
    alphabet = byte_alphabet()
    with open(path, encoding="utf-8") as f:
        return [bytes(alphabet[c] for c in t) for t in json.load(f)["model"]["vocab"]]


_LOADED: dict[tuple[str, bytes], PieceAutomaton] = {}


def load(path: str, marker: bytes = b" ") -> PieceAutomaton:
    """The automaton of a vocabulary file, built once per Python process."""
    key = (path, marker)
    if key not in _LOADED:
        _LOADED[key] = PieceAutomaton(byte_level_pieces(path), marker)
    return _LOADED[key]


class Counter:
    """Counts per document; words met before are looked up by hash."""

    def __init__(self, automaton: PieceAutomaton):
        self.automaton = automaton
        self._hash, self._count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(words, tokens) of each text."""
        w = Words(texts)
        distinct, sample, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self._hash) > REMEMBERED:
            self._hash, self._count = self._hash[:0], self._count[:0]
        n = lookup(self._hash, self._count, distinct, -1)
        new = n < 0
        if new.any():
            n[new] = self.automaton.count(w.data, w.start[sample[new]], w.end[sample[new]])
            merged = np.concatenate([self._hash, distinct[new]])
            order = np.argsort(merged, kind="stable")
            self._hash, self._count = merged[order], np.concatenate([self._count, n[new]])[order]
        upto = np.concatenate([[0], np.cumsum(n[which])])
        return np.diff(w.first), np.diff(upto[w.first])


def token_counts(docs: DataFrame, path: str, marker: str = " ", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every whole text. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load(path, marker.encode()))
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in batches_of_bytes(texts, 2_000_000):
                words, tokens = counter(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(a, b - a), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                    ["doc_id", "n_words", "n_tokens"],
                )

    return docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(text_col).alias("_text")).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long"
    )
