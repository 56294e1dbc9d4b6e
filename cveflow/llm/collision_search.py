"""Nearest neighbours by counting collisions in query-centred windows.

Vectors are dealt into blocks; a task indexes one block by ``PROJECTIONS`` random projections, each a sorted
array of values.  A query opens a window around its own value in every array.  A vector that lies in
at least ``COLLISIONS`` of the windows is verified by its true distance.  Windows widen by the factor ``GROWTH`` - virtual
rehashing: radius R stands for windows of ``WIDTH`` * R - until the k-th best verified distance is
within R.  At that radius a vector at distance R is in each window with a chance of 0.84, so nearly none is
missed, whatever the block holds; no count of candidates ends the search.

Every query is searched in every block, which is indexed once while the queries pass by, ``QUERY_BLOCK`` at a time; the k best of
all blocks are its result.  Of equal vectors only the k + 1 smallest ids can be in any result, so only
those are indexed.

Vectors that are null, empty or zero, or hold a null or a component that isn't finite, take no part, nor
do rows with a null id; only vectors of the same length are compared.  Ties go to the smaller id.  Rows that share an id are
one candidate, and one query, whose distances are the least of any of their vectors.  Components may be as large as doubles get.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cveflow.llm.arrow import offsets, ranges
from cveflow.scratch import stored

PROJECTIONS = 64
COLLISIONS = 48
WIDTH = 2.781
GROWTH = 1.25
BLOCK = 20_000
QUERY_BLOCK = 2_000
#: Components from here on are not projected, as their squares may overflow.
LARGE = 1e150


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; those whose squares overflow are scaled first."""
    with np.errstate(over="ignore"):
        near = np.sqrt(((vectors - query) ** 2).sum(1))
        for k in np.flatnonzero(~np.isfinite(near)):
            half = vectors[k] / 2 - query / 2
            scale = np.abs(half).max()
            near[k] = 2 * (scale * np.sqrt(((half / scale) ** 2).sum()))
    return near


def _top(ids: np.ndarray, near: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest ids, each at its least distance."""
    order = np.lexsort((ids, near))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


class Block:
    """Sorted projections of the vectors of one block; those too large to square are kept apart and always verified."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        large = np.abs(vectors[order]).max(1) > LARGE
        self.far_ids, self.far = ids[order][large], vectors[order][large]
        self.ids, self.vectors = ids[order][~large], vectors[order][~large]
        ids, vectors = self.ids, self.vectors
        self.axes = np.random.default_rng(17).normal(size=(PROJECTIONS, vectors.shape[1]))
        values = self.axes @ self.vectors.T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, self.order, 1)
        self.shift = np.arange(PROJECTIONS) * len(ids)
        # the search starts well below the distance at which a vector of the block usually finds its next
        probe = self.vectors[:: max(1, len(ids) // 32)]
        apart = np.sqrt(((probe[:, None] - self.vectors[None, :: max(1, len(ids) // 512)]) ** 2).sum(2))
        self.least = max(float(apart[apart > 0].min(initial=np.inf)) / 4, 1e-9) if (apart > 0).any() else 1e-9

    def _all(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For a query too large to project: every vector is verified."""
        ids = np.concatenate((self.ids, self.far_ids))
        near = distances(np.concatenate((self.vectors, self.far)), query)
        ids, near = ids[ids != own], near[ids != own]
        top = _top(ids, near, k)
        return ids[top], near[top]

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the nearest found, ``own`` left out."""
        n = len(self.ids)
        if n == 0 or np.abs(query).max() > LARGE:
            return self._all(query, own, k)
        center = self.axes @ query
        low = np.array([np.searchsorted(v, c) for v, c in zip(self.values, center)])
        high = low.copy()
        counts, checked = np.zeros(n, np.int64), self.ids == own
        other = np.flatnonzero(self.far_ids != own)
        ids, best = np.concatenate((self.ids, self.far_ids)), n + other
        near = distances(self.far[other], query)
        radius = self.least
        while True:
            half = WIDTH * radius / 2
            wider = np.array([np.searchsorted(v, c - half, "left") for v, c in zip(self.values, center)])
            upper = np.array([np.searchsorted(v, c + half, "right") for v, c in zip(self.values, center)])
            new = np.concatenate((ranges(self.shift + wider, low - wider), ranges(self.shift + high, upper - high)))
            counts += np.bincount(self.order.ravel()[new], minlength=n)
            low, high = wider, upper
            found = np.flatnonzero((counts >= COLLISIONS) & ~checked)
            checked[found] = True
            best = np.concatenate((best, found))
            near = np.concatenate((near, distances(self.vectors[found], query)))
            top = _top(ids[best], near, k)
            best, near = best[top], near[top]
            if checked.all() or (len(best) == k and near[-1] <= radius):
                return ids[best], near
            radius *= GROWTH


def _vectors(column: pa.Array) -> np.ndarray:
    at = offsets(column)
    return np.asarray(column.values, np.float64)[at[0] : at[-1]].reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``queries`` holds, among all others."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), queries.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    points = rows.groupBy("vector", "vec_id").agg(F.first("dim").alias("dim"))
    points = stored(points.withColumn("place", F.row_number().over(copies)).where(F.col("place") <= k + 1).select("vec_id", "vector", "dim"), "points")
    asked = stored(rows.where("asks").groupBy("vec_id", "vector").agg(F.first("dim").alias("dim")), "queries")
    n_blocks = 1 + points.count() // BLOCK
    shape = ["block", "dim", "asks", "vec_id", "vector"]
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    # every query meets every block; no vector is copied
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("asks", F.lit(True))
    both = points.withColumn("block", block).withColumn("asks", F.lit(False)).select(*shape).unionByName(asked.select(*shape))
    dealt = both.repartitionById(n_blocks, "block").sortWithinPartitions("block", "dim", "asks", "vec_id")
    each = dealt.mapInArrow(_searched(k), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    least = each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return least.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searched(k: int):
    """Each block is indexed once, when its vectors have been read; its queries follow and pass by in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting, index = None, [], None
        for batch in batches:
            block, dim, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            new = np.ones(len(block), bool)
            new[1:] = (block[1:] != block[:-1]) | (dim[1:] != dim[:-1]) | (asks[1:] != asks[:-1])
            first = np.flatnonzero(new).tolist()
            for a, b in zip(first, [*first[1:], len(block)]):
                if (block[a], dim[a]) != last:
                    last, waiting, index = (block[a], dim[a]), [], None
                part = batch.slice(a, b - a)
                if not asks[a]:
                    waiting.append((np.asarray(part.column(3)), _vectors(part.column(4))))
                    continue
                if waiting:
                    index = Block(*(np.concatenate(c) for c in zip(*waiting)))
                    waiting = []
                for at in range(0, b - a if index else 0, QUERY_BLOCK):
                    some = part.slice(at, QUERY_BLOCK)
                    found = [(own, i, d) for own, query in zip(some.column(3).to_pylist(), _vectors(some.column(4)))
                             for i, d in zip(*map(np.ndarray.tolist, index.search(query, own, k)))]
                    columns = list(zip(*found)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])
    return run
