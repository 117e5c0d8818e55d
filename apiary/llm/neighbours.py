"""Approximate nearest neighbours: collision-counting hashing.

Vectors are dealt to blocks of bounded size by a hash of their id. In a block,
each of ``PROJECTIONS`` random directions gives one sorted array of projections.
A query opens a window centred on its own projection in every array; the radius
grows by ``GROWTH`` (virtual rehashing: the windows widen, nothing is hashed
anew) and only the new rings are read. A vector collides once per array whose
window holds it; vectors with ``threshold`` collisions are verified by their true
cosine. The threshold is set so that a vector within the radius reaches it with
probability ``SURE`` or more. A query is done when its k-th verified distance is
within the radius; at radius 2, the largest distance of unit vectors, every vector of the block is
verified, so no case is left over.

Queries meet all blocks: a stated query set against all rows, in blocks. Every
row is indexed; nothing is sampled. Recall is measured in tests.

Nearness is the cosine of the original vectors in double precision (scaled by
their largest component first, so that squares neither overflow nor vanish).

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite
component take no part, nor do rows without id; of rows that repeat an id the
smallest vector counts; vectors of different length never meet; ties go to the
smaller id; with fewer than k candidates all are returned; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apiary.llm.common import stage

PROJECTIONS = 24
WIDTH = 1.0
SURE = 0.9
# Distances of unit vectors; the last stands for "all".
RADII = (0.25, 0.5, 0.75, 0.9, 1.0, 1.07, 1.14, 1.22, 1.31, 1.41, 1.6, 1.8, 2.0)
BLOCK, QUERY_BLOCK = 8192, 4096


def threshold(m: int = PROJECTIONS, width: float = WIDTH, sure: float = SURE) -> int:
    """Largest count that a vector at the radius reaches with probability ``sure``."""
    p = math.erf(width / math.sqrt(2))
    tail = 0.0
    for c in range(m, 0, -1):
        tail += math.comb(m, c) * p**c * (1 - p) ** (m - c)
        if tail >= sure:
            return c
    return 1


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, packed, dims = [], [], []
        for i, v in zip(batch.column("_id").to_pylist(), batch.column("_vec").to_pylist(), strict=True):
            if v and None not in v:
                a = np.array(v, dtype=np.float64)
                if np.isfinite(a).all() and a.any():
                    ids.append(i)
                    packed.append(a.tobytes())
                    dims.append(len(a))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(dims, pa.int32())], ["_id", "_vec", "_dim"]
        )


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(_id, _vec, _dim): vectors that take part, as packed doubles, one row per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast("array<double>").alias("_vec")).where(
        "_id is not null and _vec is not null"
    )
    return rows.mapInArrow(_valid, "_id long, _vec binary, _dim int").groupBy("_id").agg(
        F.min(F.struct("_vec", "_dim")).alias("_v")
    ).select("_id", "_v.*")


class BlockIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = PROJECTIONS):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        scaled = vectors[order] / np.abs(vectors[order]).max(axis=1, keepdims=True)
        self.unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
        self.scaled = scaled
        self.norm = np.sqrt((scaled * scaled).sum(axis=1))
        self.directions = np.random.default_rng(11).normal(size=(vectors.shape[1], m))
        projected = (self.unit @ self.directions).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.need = threshold(m)

    def search(self, queries: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: its id, and ids and cosines of the k nearest found, nearest first."""
        reach = np.array(RADII) * WIDTH
        for at in range(0, len(queries), 256):
            q = vectors[at : at + 256]
            q = q / np.abs(q).max(axis=1, keepdims=True)
            norm = np.sqrt((q * q).sum(axis=1))
            centre = (q / norm[:, None]) @ self.directions
            # Window borders of every query in every array at every radius.
            low = np.stack([np.searchsorted(s, c[:, None] - reach) for s, c in zip(self.sorted, centre.T, strict=True)], axis=1)
            high = np.stack([np.searchsorted(s, c[:, None] + reach, side="right") for s, c in zip(self.sorted, centre.T, strict=True)], axis=1)
            for i in range(len(q)):
                yield int(queries[at + i]), *self._search(int(queries[at + i]), q[i], norm[i], low[i], high[i], k)

    def _search(self, query_id, q, norm, low, high, k) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        own = np.searchsorted(self.ids, query_id)
        own = own if own < n and self.ids[own] == query_id else -1
        hits = np.zeros(n, dtype=np.int64)
        cosine = np.full(n, -np.inf)
        verified = np.zeros(n, dtype=bool)
        top, kth = np.zeros(0), -np.inf
        if own >= 0:
            verified[own] = True
        for t, radius in enumerate(RADII):
            if radius >= 2.0 or n <= k:
                new = np.flatnonzero(~verified)
            else:
                if t == 0:
                    rings = [o[a:b] for o, a, b in zip(self.order, low[:, 0].tolist(), high[:, 0].tolist(), strict=True)]
                else:
                    rings = [o[a:b] for o, a, b in zip(self.order, low[:, t].tolist(), low[:, t - 1].tolist(), strict=True)]
                    rings += [o[a:b] for o, a, b in zip(self.order, high[:, t - 1].tolist(), high[:, t].tolist(), strict=True)]
                hits += np.bincount(np.concatenate(rings), minlength=n)
                new = np.flatnonzero((hits >= self.need) & ~verified)
            if len(new):
                cosine[new] = (self.scaled[new] @ q) / (self.norm[new] * norm)
                verified[new] = True
                top = np.concatenate([top, cosine[new]])
                if len(top) > k:
                    top = np.partition(top, len(top) - k)[-k:]
                kth = top.min() if len(top) == k else -np.inf
            if kth > -np.inf and 2.0 - 2.0 * kth <= radius * radius:
                break
        # The nearest anew, row by row, so that equal vectors get equal sums wherever they stand.
        best = np.flatnonzero((cosine >= kth - 1e-9) & (cosine > -np.inf))
        exact = (self.scaled[best] * q).sum(axis=1) / (self.norm[best] * norm)
        first = np.lexsort((self.ids[best], -exact))[:k]
        return self.ids[best[first]], exact[first]


def _search_block(k: int):
    def run(rows: pa.Table) -> pa.Table:
        ids = rows["_id"].to_numpy()
        is_query = np.array(rows["_query"].to_pylist(), dtype=bool)
        dim = rows["_dim"][0].as_py()
        packed = np.frombuffer(b"".join(rows["_vec"].to_pylist()), dtype=np.float64).reshape(-1, dim)
        queries, found, scores = [], [], []
        if (~is_query).any():
            index = BlockIndex(ids[~is_query], packed[~is_query])
            for i, near, cosine in index.search(ids[is_query], packed[is_query], k):
                queries += [i] * len(near)
                found += near.tolist()
                scores += cosine.tolist()
        return pa.table(
            {"query_id": pa.array(queries, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())}
        )

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which
    ``is_query`` (a condition on the id, given as column ``_id``) holds."""
    rows = stage(valid_vectors(vectors, id_col, vec_col).withColumn("_asks", F.coalesce(is_query, F.lit(False))), "vectors")
    sizes = rows.agg(F.count("*"), F.count(F.when(F.col("_asks"), 1))).first()
    blocks, query_blocks = max(1, -(-sizes[0] // block)), max(1, -(-sizes[1] // query_block))

    def dealt(df: DataFrame, n: int, others: int, own: str, other: str) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("_id"), F.lit(n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        )

    data = dealt(rows.withColumn("_query", F.lit(False)), blocks, query_blocks, "_block", "_queries")
    asked = dealt(rows.where("_asks").withColumn("_query", F.lit(True)), query_blocks, blocks, "_queries", "_block")
    columns = ["_dim", "_block", "_queries", "_id", "_vec", "_query"]
    found = (
        data.select(*columns)
        .unionByName(asked.select(*columns))
        .groupBy("_dim", "_block", "_queries")
        .applyInArrow(_search_block(k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
