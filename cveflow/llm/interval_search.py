"""Ranked lexical search by document intervals with range-maximum bounds.

Documents are dealt into shards.  A shard holds one posting list per term, in the order of the document ids, and over each list a
sparse table that names the posting with the largest impact in any range.  For an item, an interval of documents is bounded
by the sum of its terms' largest impacts there.  Search is best first: the interval with the highest bound is split at the document
that has the largest of those impacts; that document is scored exactly, and the two intervals beside it are bounded again.
Intervals whose bound can't reach the best ones found so far are dropped, so no document that belongs to the result is missed.

Items are taken in blocks of at most ``BLOCK`` bytes of text (or one item), so what is broadcast doesn't grow with their
number.  Documents are read once a block; what is stored of them are the postings of the block's terms.

Terms are maximal runs of ASCII letters, digits and characters outside ASCII, A-Z lower-cased.  A null text has none, nor an empty one.
Rows of documents with the same id, or even the same text, are documents of their own, and each can be in a result; equal scores are in
the order of the ids, null last, and in no set order where ids are equal, too.  Rows of items with the same id and text count as one; with different texts,
each has its own ranks.  Items without terms, or without a document that shares one, give no rows.  Other columns are left
out.  Very long texts are cut between terms while they are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cveflow.llm.arrow import lists, offsets
from cveflow.llm.tokens import distinct, lowered, parts, runs
from cveflow.scratch import stored

#: Bytes of items searched for in one go.
BLOCK = 1 << 22
#: Postings of a shard; it ends with the batch of rows that reaches them.
POSTINGS = 1 << 20
#: Intervals split at a time.
BATCH = 64

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    """All terms of a text in order."""
    data = lowered(np.frombuffer(text, np.uint8))
    start, size, _ = runs(data, np.array([0, len(data)]), _INSIDE)
    raw = data.tobytes()
    return [raw[s : s + n] for s, n in zip(start.tolist(), size.tolist())]


SHARDS = ("n_docs bigint, n_terms bigint, ids array<bigint>, sizes array<bigint>, "
          "terms array<int>, counts array<int>, docs array<int>, tf array<int>")


class _Shard:
    """Postings gathered so far."""

    def __init__(self):
        self.n_docs = self.n_terms = self.rows = self.postings = 0
        self.ids: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []

    def add(self, batch: pa.RecordBatch, wanted: dict[bytes, int]) -> None:
        sizes = np.zeros(batch.num_rows, np.int64)
        for data, at, owner in parts(batch, ~_INSIDE):
            data = lowered(data)
            start, size, counts = runs(data, at, _INSIDE)
            np.add.at(sizes, owner, counts)
            ids, words = distinct(data, start, size)
            known = np.array([wanted.get(w, -1) for w in words], np.int64)
            term = known[ids] if len(words) else ids
            row = np.repeat(owner, counts)[term >= 0] + self.rows
            self.keys.append(term[term >= 0] << 32 | row)
        self.n_docs += int((sizes > 0).sum())
        self.n_terms += int(sizes.sum())
        self.postings += sum(map(len, self.keys[-1:]))
        self.rows += batch.num_rows
        column = batch.column(0)
        self.ids.append(column.fill_null(_NO_ID).to_numpy(zero_copy_only=False))
        self.sizes.append(sizes)

    def row(self) -> pa.RecordBatch:
        """Documents without a posting are left out, the others numbered in the order of their ids."""
        key, tf = np.unique(np.concatenate(self.keys), return_counts=True)
        term, row = key >> 32, key & 0xFFFFFFFF
        ids, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        some = np.unique(row)
        some = some[np.argsort(ids[some], kind="stable")]
        number = np.empty(len(ids), np.int64)
        number[some] = np.arange(len(some))
        order = np.argsort(term << 32 | number[row])
        named, counts = np.unique(term, return_counts=True)
        one = lambda x, t: lists(x.astype(t), np.array([0, len(x)]))
        columns = [pa.array([self.n_docs]), pa.array([self.n_terms]), one(ids[some], np.int64), one(sizes[some], np.int64),
                   *(one(x, np.int32) for x in (named, counts, number[row][order], tf[order]))]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SHARDS.split(", ")])


def _shards(wanted, postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            shard.add(batch, wanted.value)
            if shard.postings >= postings:
                yield shard.row()
                shard = _Shard()
        if shard.rows:
            yield shard.row()
    return run


class Postings:
    """Posting lists of a shard one after the other, and their range-maximum tables."""

    def __init__(self, named: np.ndarray, counts: np.ndarray, docs: np.ndarray, impact: np.ndarray):
        ends = np.cumsum(counts)
        self.lists = {t: (e - c, e) for t, c, e in zip(named.tolist(), counts.tolist(), ends.tolist())}
        self.docs, self.impact = docs, impact
        self.key = np.repeat(np.arange(len(named)), counts) << 32 | docs
        self.place = {t: k for k, t in enumerate(named.tolist())}
        table = [np.arange(len(docs), dtype=np.int32)]
        width = 1
        while 2 * width <= (int(counts.max()) if len(counts) else 0):
            left, right = table[-1], np.append(table[-1][width:], table[-1][-width:])
            table.append(np.where(impact[left] >= impact[right], left, right))
            width *= 2
        self.table = np.stack(table)

    def best(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Posting with the largest impact in each non-empty range."""
        level = np.frexp(high - low)[1] - 1
        left, right = self.table[level, low], self.table[level, high - (1 << level)]
        return np.where(self.impact[left] >= self.impact[right], left, right)


def search(index: Postings, ids: np.ndarray, item: list[tuple[int, int]], top: list[tuple[int, int, int]], k: int, batch: int = BATCH) -> None:
    """Bring ``top``, a heap of ``(score, -id, ...)`` with the ``k`` best documents so far, up to date with a shard.

    ``item`` is a list of ``(term, weight)``.
    """
    item = [(t, w) for t, w in item if t in index.lists and w > 0]
    if not item:
        return
    weight = np.array([w for _, w in item])
    base = np.array([index.place[t] for t, _ in item]) << 32
    heap: list[tuple] = []
    entry = 0

    def push(low: np.ndarray, high: np.ndarray, first: np.ndarray) -> None:
        nonlocal entry
        some = low < high
        at = np.where(some, index.best(np.where(some, low, 0), np.where(some, high, 1)), 0)
        gain = np.where(some, index.impact[at], 0) * weight
        bound = gain.sum(1)
        split = index.docs[at[np.arange(len(at)), gain.argmax(1)]]
        for r in np.flatnonzero(bound > 0).tolist():
            if len(top) < k or (bound[r], -ids[first[r]]) > top[0][:2]:
                heapq.heappush(heap, (-int(bound[r]), int(first[r]), entry, low[r], high[r], int(split[r])))
                entry += 1

    start, end = (np.array([index.lists[t][j] for t, _ in item])[None] for j in (0, 1))
    push(start, end, np.zeros(1, np.int64))
    size = 1
    while heap:
        taken = []
        while heap and len(taken) < size:
            found = heapq.heappop(heap)
            if len(top) == k and (-found[0], -int(ids[found[1]])) < top[0][:2]:
                heap = []
                break
            taken.append(found)
        if not taken:
            return
        low, high = np.stack([x[3] for x in taken]), np.stack([x[4] for x in taken])
        first, split = np.array([x[1] for x in taken]), np.array([x[5] for x in taken])
        at = np.searchsorted(index.key, base[None] + split[:, None])
        there = (at < high) & (index.docs[np.minimum(at, len(index.docs) - 1)] == split[:, None])
        score = np.where(there, index.impact[np.where(there, at, 0)] * weight, 0).sum(1)
        for s, d in zip(score.tolist(), split.tolist()):
            found = (s, -int(ids[d]), d)
            if len(top) < k:
                heapq.heappush(top, found)
            elif found[:2] > top[0][:2]:
                heapq.heapreplace(top, found)
        push(low, at, first)
        more = np.flatnonzero(split + 1 < len(ids))
        push((at + there)[more], high[more], split[more] + 1)
        size = min(2 * size, batch)


def _impacts(tf: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one occurrence pattern of a term is worth in a document, before the term's weight."""
    if len(sizes) and 75 * int(sizes.max()) * n_docs >= 1 << 63:
        long = np.array([75 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)
    else:
        long = 75 * sizes * n_docs // max(n_terms, 1)
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * (25 + long))


FOUND = "item int, doc_id bigint, score bigint"


def _searched(items, n_docs: int, n_terms: int, k: int):
    """Best documents of all shards of a task, for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list] = [[] for _ in items.value]
        for batch in batches:
            for r in range(batch.num_rows):
                ids, sizes, named, counts, docs, tf = (_values(batch.column(c), r) for c in range(6))
                if not len(docs):
                    continue
                docs = docs.astype(np.int64)
                index = Postings(named, counts, docs, _impacts(tf, sizes[docs], n_docs, n_terms))
                for item, top in zip(items.value, tops):
                    search(index, ids, item, top, k)
        rows = [(n, None if -i == _NO_ID else -i, s) for n, top in enumerate(tops) for s, i, _ in top]
        if rows:
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])
    return run


def _values(column: pa.Array, row: int) -> np.ndarray:
    at = offsets(column)
    return column.values.slice(at[row], at[row + 1] - at[row]).to_numpy()


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items and their terms, a block at a time; the driver holds no more than one."""
    block: list[tuple[int | None, list[bytes]]] = []
    size = 0
    for row in items.where("text is not null").select("item_id", "text").distinct().toLocalIterator():
        raw = row.text.encode()
        if block and size + len(raw) > limit:
            yield block
            block, size = [], 0
        block.append((row.item_id, terms(raw)))
        size += len(raw)
    if block:
        yield block


def _block_ranks(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int, postings: int) -> DataFrame:
    spark = docs.sparkSession
    wanted = {t: n for n, t in enumerate(sorted({t for _, found in block for t in found}))}
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shards = stored(rows.mapInArrow(_shards(spark.sparkContext.broadcast(wanted), postings), SHARDS), "shards")
    n_docs, n_terms = (int(x or 0) for x in shards.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    # at most one row per term of the block
    held = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df"))
    weight = {r.terms: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in held.collect()}
    items = [[(wanted[t], weight[wanted[t]] * n) for t, n in Counter(found).items() if wanted[t] in weight] for _, found in block]
    best = shards.select("ids", "sizes", "terms", "counts", "docs", "tf").mapInArrow(
        _searched(spark.sparkContext.broadcast(items), n_docs, n_terms, k), FOUND)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for part in (["item", "part"], ["item"]):
        best = best.withColumn("part", F.spark_partition_id() % 64)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("rank") <= k)
    named = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item int, item_id bigint")
    return stored(best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"), "ranks")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK, postings: int = POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 of each item."""
    found = [_block_ranks(docs, b, k, postings) for b in _blocks(items, block)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found)
