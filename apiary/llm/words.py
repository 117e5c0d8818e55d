"""Word splitting and hashing over whole Arrow batches of texts.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return (``[^\\x20\\x09-\\x0D]+``); in UTF-8 none of these bytes
occurs inside another character. All functions work on raw UTF-8 bytes and on
whole batches, so the cost per document is a few numpy calls, not a Python
loop over words. Hashes are 64-bit and depend only on the bytes, never on the
process, the partitioning or the batch.
"""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def seeded(name: str, n: int) -> np.ndarray:
    """``n`` fixed 64-bit values derived from ``name``."""
    out = b"".join(hashlib.sha256(f"{name}/{i}".encode()).digest() for i in range(-(-n // 4)))
    return np.frombuffer(out, dtype="<u8")[:n].astype(U64)


_BYTE_VALUES = seeded("byte", 256)
BASE_BYTE, BASE_WORD, BASE_WINDOW_A = (int(v) | 1 for v in seeded("base", 3))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for ``i < n`` (kept, grown by doubling)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 12, 1 << int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.empty(size, dtype=U64)
            p[0], done, step = 1, 1, b
            while done < size:
                p[done : 2 * done] = p[:done] * U64(step)
                step = step * step % (1 << 64)
                done *= 2
            out.append(p)
        have = _POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hash of ``values[starts[i]:ends[i]]`` for every ``i``: one prefix
    sum of ``value * base**position``, a difference per run, shifted back to
    position 0 by the inverse power."""
    p, inv = powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * p[: len(values)], dtype=U64, out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * inv[starts]


NEVER = np.iinfo(np.int64).max


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: int) -> np.ndarray:
    """The value of each wanted key in the sorted ``keys``, or ``missing``."""
    if not len(keys):
        return np.full(wanted.shape, missing, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run ``data[start:end]`` (its bytes and length).

    Each byte is mixed with its place in the run before the sum. A polynomial
    modulo 2**64 would not do: some pairs of long runs (Thue-Morse words over two
    letters) have the same polynomial in every odd base.
    """
    length = end - start
    upto = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(length, out=upto[1:])
    place = np.arange(upto[-1]) - np.repeat(upto[:-1], length)
    byte = data[np.repeat(start, length) + place]
    prefix = np.zeros(upto[-1] + 1, dtype=U64)
    np.cumsum(mix(_BYTE_VALUES[byte] + place.astype(U64) * U64(BASE_BYTE)), dtype=U64, out=prefix[1:])
    return mix(prefix[upto[1:]] - prefix[upto[:-1]] + length.astype(U64))


class Words:
    """Words of one batch of texts.

    ``start`` / ``end``: byte range of each word in ``data``; ``first[d]`` to
    ``first[d + 1]``: the words of text ``d``. A null text has no words.
    """

    def __init__(self, texts, lower: bool = False):
        parts = [t if t is not None else b"" for t in texts]
        data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
        self.data = _LOWER[data] if lower else data
        lengths = np.fromiter((len(t) for t in parts), dtype=np.int64, count=len(parts))
        at = np.zeros(len(parts) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=at[1:])
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[1:] = ~_SPACE[data]
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, at)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word (its bytes and length)."""
        return hash_runs(self.data, self.start, self.end)


def batches_of_bytes(texts, limit: int = 1_000_000):
    """Cut a batch into ranges of at most about ``limit`` bytes of text (one longer text stands alone)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n + 1
    if begin < len(texts):
        yield begin, len(texts)
