"""Approximate nearest neighbours by query-aware collision counting.

Index. Vectors are dealt to blocks by a hash of their id; in each block, each of
``M`` random projections has its values in a sorted array. Search. For a query,
a window centred on the query's own projection grows in every array by virtual
rehashing: its half width is ``WIDTH / 2`` times a radius that grows by
``GROWTH``, and a step only visits what the window gained. A vector found in at
least ``THRESHOLD`` windows is verified by its exact distance in double
precision. A block is done for a query when its k-th verified distance is at
most the radius: a vector within the radius lies in each window with probability
``2 * Phi(WIDTH / 2) - 1`` (0.68) at least, so it passes the threshold with
probability 0.87 at the radius itself and more below it. Every block returns its k best, and the k best of all blocks remain.

The query set meets all vectors block by block: queries in blocks of
``QUERY_BLOCK``, vectors in blocks of ``VECTOR_BLOCK``; each pair of blocks is a
task of bounded memory.

Defined cases: vectors that are null, zero, hold null or non-finite components
or have another length than most, and rows without id, take no part; equal rows
count once, rows that share an id but not the vector are separate candidates (no
query sees its own id), and such a query uses the smallest vector; ties go to
the smaller id; other columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 10
M = 64
THRESHOLD = 40
WIDTH = 2.0
GROWTH = 1.15
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024


def projections(dim: int, m: int = M) -> np.ndarray:
    return np.random.default_rng(20_011).standard_normal((dim, m))


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distance in double precision, summed component by component in one order for all."""
    difference = vectors - query
    return np.sqrt((difference * difference).sum(axis=1))


class Block:
    """Sorted projection arrays over the vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.axes = projections(vectors.shape[1])
        values = vectors @ self.axes
        self.order = np.argsort(values, axis=0).T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)

    def start(self) -> float:
        """First radius: a window of about a hundredth of an array's middle half."""
        n = len(self.ids)
        middle = self.sorted[:, (3 * n) // 4] - self.sorted[:, n // 4]
        return max(float(np.median(middle)) / 50, 1e-12) * 2 / WIDTH

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
        """Per query the rows of its k nearest found and their distances, and how many rows were verified in all."""
        n, m = len(self.ids), self.order.shape[0]
        centre = queries @ self.axes
        low = np.stack([np.searchsorted(self.sorted[j], centre[:, j]) for j in range(m)], axis=1)
        high = low.copy()
        count = np.zeros((len(queries), n), np.int16)
        best_row = [np.zeros(0, np.int64) for _ in queries]
        best = [np.zeros(0) for _ in queries]
        base = np.arange(m) * n
        flat_order = self.order.ravel()
        active = np.arange(len(queries))
        radius, verified = self.start(), 0
        while len(active):
            half = radius * WIDTH / 2
            left = np.stack([np.searchsorted(self.sorted[j], centre[active, j] - half, "left") for j in range(m)], axis=1)
            right = np.stack([np.searchsorted(self.sorted[j], centre[active, j] + half, "right") for j in range(m)], axis=1)
            going = []
            for a, q in enumerate(active):
                # what both sides of every window gained, as positions in the sorted arrays
                begin = np.r_[base + left[a], base + high[q]]
                size = np.r_[low[q] - left[a], right[a] - high[q]]
                at = np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                before = count[q].copy()
                after = before + np.bincount(flat_order[at], minlength=n).astype(np.int16)
                count[q] = after
                low[q], high[q] = left[a], right[a]
                new = np.flatnonzero((after >= THRESHOLD) & (before < THRESHOLD))
                new = new[self.ids[new] != query_ids[q]]
                if len(new):
                    verified += len(new)
                    row = np.r_[best_row[q], new]
                    d = np.r_[best[q], distances(self.vectors[new], queries[q])]
                    keep = np.lexsort((self.ids[row], d))[:k]
                    best_row[q], best[q] = row[keep], d[keep]
                everything = (right[a] - left[a]).min() >= n
                if not everything and (len(best[q]) < k or best[q][-1] > radius):
                    going.append(q)
            active = np.array(going, np.int64)
            radius *= GROWTH
        return best_row, best, verified


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def search_block(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k nearest found in one block of vectors for each of one block of queries."""
    if not len(vectors) or not len(queries):
        return FOUND.empty_table()
    ids, x = np.asarray(vectors.column("vec_id")), _matrix(vectors.column("embedding"))
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    fresh = np.r_[True, (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(axis=1)]
    ids, x = ids[fresh], x[fresh]
    qids, q = np.asarray(queries.column("query_id")), _matrix(queries.column("embedding"))
    rows, scores, _ = Block(ids, x).search(qids, q, k)
    return pa.table(
        [
            pa.array(np.repeat(qids, [len(r) for r in rows])),
            pa.array(ids[np.concatenate(rows)]),
            pa.array(np.concatenate(scores)),
        ],
        schema=FOUND,
    )


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding as array<double>) of the rows that take part."""
    v = F.col("embedding")
    two = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    sound = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return two.filter(F.col("vec_id").isNotNull() & v.isNotNull() & sound)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest found among ``vectors``."""
    index, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    sizes = index.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim, n = (sizes["dim"], sizes["count"]) if sizes else (0, 0)
    index = index.filter(F.size("embedding") == dim)
    asked = asked.filter(F.size("embedding") == dim).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    n_queries = asked.count()
    blocks, query_blocks = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    def every(size: int):
        return F.explode(F.sequence(F.lit(0), F.lit(size - 1)))

    left = index.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("part", every(query_blocks))
    right = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")).withColumn("block", every(blocks))
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        lambda v, q: search_block(v, q, k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
