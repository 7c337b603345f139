"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into 1, 4 and 16 segments (as far as its length divides); each
segment keeps its sum's mean and its deviation.  For two vectors the squared
distance is at least the sum over segments of size * ((mean - mean')^2 +
(dev - dev')^2), and equally the inner product is at most the sum of
size * (mean * mean' + dev * dev'); the two bounds are one, since
2 q.x = |q|^2 + |x|^2 - |q - x|^2.  Pairs whose bound stays below the query's k-th
best score so far are dropped level by level, coarse to fine; the rest get exact
integer scores.

Work is laid out in blocks: queries in blocks of ``QUERY_BLOCK``, candidates in
chunks of about ``CHUNK`` rows, one group for each block and chunk; a group gives at
most k rows for each of its queries, and a window takes the best of those.

Defined results: vectors that are null, empty or hold null or non-finite components,
and rows without an id, take no part; vectors of another length than the query's are
no candidates; of rows that repeat an id the smallest vector counts; fewer than k
candidates give all; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import batches, held

K = 10
EVERY = 100
SCALE = 1024
QUERY_BLOCK, CHUNK = 512, 16_384
SEGMENTS = (1, 4, 16)
#: Rows of a chunk that are bounded against the query block at once.
STEP = 1024


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with integer components of the vectors that take part, one row for each id."""
    e = F.col("embedding")
    fine = (
        F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    )
    ints = F.transform(e, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(fine).select("vec_id", ints.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


class Statistics:
    """Means and deviations of the rows of a matrix at one resolution, scaled by the segment size."""

    def __init__(self, rows: np.ndarray, segments: int):
        cut = rows.reshape(len(rows), segments, -1)
        root = np.sqrt(cut.shape[2])
        mean = cut.mean(2)
        dev = np.sqrt(np.maximum((cut * cut).mean(2) - mean * mean, 0))
        self.table = np.concatenate((mean, dev), axis=1) * root


def resolutions(length: int) -> list[int]:
    return [s for s in SEGMENTS if length % s == 0 and s <= length]


class Search:
    """Best candidates so far of a block of queries of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        as_float = vectors.astype(float)
        self.levels = [(s, Statistics(as_float, s).table) for s in resolutions(vectors.shape[1])]
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.size = np.zeros(len(ids), np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        as_float = vectors.astype(float)
        # the k-th best score; nothing is dropped while a query has fewer than k
        floor = np.where(self.size >= self.k, self.score[:, -1].astype(float), -np.inf)
        q = c = None
        for s, mine in self.levels:
            theirs = Statistics(as_float, s).table
            if q is None:
                bound = mine @ theirs.T
                q, c = np.nonzero(self._may(bound, floor[:, None]) & (self.ids[:, None] != ids[None, :]))
            else:
                bound = np.einsum("ij,ij->i", mine[q], theirs[c])
                keep = self._may(bound, floor[q])
                q, c = q[keep], c[keep]
            if not len(q):
                return
        exact = np.einsum("ij,ij->i", self.vectors[q], vectors[c])
        at = np.flatnonzero(np.diff(q, prepend=-1))
        for a, b in zip(at, [*at[1:], len(q)]):
            self._merge(int(q[a]), exact[a:b], ids[c[a:b]])

    @staticmethod
    def _may(bound: np.ndarray, floor: np.ndarray) -> np.ndarray:
        # rounding of the bound must not drop a pair
        return bound + 1e-9 * np.abs(bound) + 1.0 >= floor

    def _merge(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        n = int(self.size[i])
        score = np.concatenate((self.score[i, :n], score))
        ids = np.concatenate((self.found[i, :n], ids))
        best = np.lexsort((ids, -score))[: self.k]
        self.size[i] = len(best)
        self.score[i, : len(best)] = score[best]
        self.found[i, : len(best)] = ids[best]

    def rows(self):
        for i, query in enumerate(self.ids.tolist()):
            n = int(self.size[i])
            for vec, score in zip(self.found[i, :n].tolist(), self.score[i, :n].tolist()):
                yield query, vec, score


def search(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` of all other rows for each row
    whose id is divisible by ``every``."""
    rows = held(quantised(vectors).withColumn("n", F.size("v")))
    queries = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_queries = rows.count(), queries.count()
    blocks, chunks = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_rows // CHUNK))

    def all_of(name: str, n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def own(n: int, seed: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")

    grid = (
        queries.select(own(blocks, 1).alias("block"), all_of("chunk", chunks), "n", F.lit(0).alias("kind"), "vec_id", "v")
        .unionByName(
            rows.select(all_of("block", blocks), own(chunks, 2).alias("chunk"), "n", F.lit(1).alias("kind"), "vec_id", "v")
        )
    )
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches_in):
        def rows_():
            key = search_ = None
            pending: list = []

            def flush():
                nonlocal search_, pending
                if not pending:
                    return
                kind, length = pending[0][0], pending[0][3]
                ids = np.concatenate([p[1] for p in pending])
                v = np.concatenate([p[2] for p in pending]).reshape(len(ids), length)
                pending = []
                if kind == 0:
                    search_ = Search(ids, v, k)
                elif search_ is not None:
                    for a in range(0, len(ids), STEP):
                        search_.add(ids[a : a + STEP], v[a : a + STEP])

            for batch in batches_in:
                cell = np.column_stack([batch.column(i).to_numpy() for i in range(4)])
                ids = batch.column(4).to_numpy()
                flat = batch.column(5)
                bounds = np.flatnonzero((np.diff(cell, axis=0, prepend=-1) != 0).any(1))
                for a, b in zip(bounds, [*bounds[1:], len(ids)]):
                    block, chunk, length, kind = (int(x) for x in cell[a])
                    if (block, chunk, length) != key:
                        flush()
                        if search_ is not None:
                            yield from search_.rows()
                        key, search_ = (block, chunk, length), None
                    elif pending and pending[0][0] != kind:
                        flush()
                    part = flat.slice(a, b - a).flatten().to_numpy()
                    pending.append((kind, ids[a:b], part, length))
                    if kind == 1 and sum(len(p[1]) for p in pending) >= 8 * STEP:
                        flush()
            flush()
            if search_ is not None:
                yield from search_.rows()

        yield from batches(rows_(), out)

    keys = ["block", "chunk", "n", "kind"]
    found = (
        grid.repartition("block", "chunk", "n").sortWithinPartitions(*keys)
        .select(*keys, "vec_id", "v").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
