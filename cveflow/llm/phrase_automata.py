"""Phrase collocations from weighted acyclic automata.

Words are the symbols, and a path from the start spells a phrase.  A state's weight is the number of places where its path
runs up to the end of the piece or to ``LONGEST`` words; so the occurrences of a phrase are the weights of all states its path leads to.

1. Each task reads its texts in slices, sorts the up to ``LONGEST`` words from every place on, and builds the count automaton of the
   slice from the sorted list.  Automata are united, the weights of equal paths summed, until one is a
   shard of ``SHARD`` paths, which is stored.
2. The sorted paths of all shards are cut into prefix ranges of about ``RANGE`` paths each; their borders come from a bounded sample of paths,
   which steers how evenly tasks are loaded, not what they count.  A range of very frequent words is cut at later words.
3. The parts of all shards that belong to a range are united in one task, which then knows the count of every phrase that starts
   there.  Phrases on the border of a range reach into the next one: their counts are emitted whatever they are and added up.
4. Phrases of two words or more are composed with the counts: their first and last parts are looked up for every cut.

Scores are exact: products are decimals of up to 38 digits.

A null text is empty; a null language is ``und``.  Repeated rows count as often as they occur, whatever their ids, which aren't read.  Other
columns are left out.  Texts without words count nothing, and languages without a candidate give no rows.  Ties are
broken by frequency, then by phrase, so every rank is unique.  Very long texts are cut between pieces while they are read.  An empty table gives
an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cveflow.llm.frames import attach
from cveflow.llm.tokens import distinct, lowered, parts, runs
from cveflow.scratch import stored

LONGEST = 5
#: Paths of a stored shard, and of a prefix range.
SHARD = 1 << 20
RANGE = 1 << 20
#: Prefix ranges at most, and sampled paths for each of them.
RANGES = 1 << 20
SAMPLED = 8
#: Paths a full shard offers for the sample.
OFFERED = 64

_APART = np.zeros(256, bool)
#: Fixed value: the characters that end a piece.
_APART[[*b".,;:!?", *range(10, 14)]] = True
_INSIDE = ~_APART
_INSIDE[[9, 32]] = False


class Automaton:
    """Sorted distinct paths of words with the weights of their last states.

    ``words`` are the symbols in byte order, ``paths`` the places of a path's words plus one, 0 behind its end.
    """

    def __init__(self, words: Sequence[bytes], paths: np.ndarray, weights: np.ndarray):
        self.words, self.paths, self.weights = words, paths, weights

    @classmethod
    def sorted(cls, words: Sequence[bytes], paths: np.ndarray, weights: np.ndarray) -> Automaton:
        """From paths in any order; the weights of equal ones are summed."""
        keys = _keys(paths, len(words))
        order = np.lexsort(keys[::-1])
        first = np.zeros(len(paths), bool)
        first[:1] = True
        for key in keys:
            key = key[order]
            first[1:] |= key[1:] != key[:-1]
        at = np.flatnonzero(first)
        return cls(words, paths[order[at]], np.add.reduceat(weights[order], at) if len(at) else weights)

    def states(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per depth: the path at which each state is first reached, and the number of the state its arc comes from."""
        new = np.zeros(len(self.paths), bool)
        new[:1] = True
        out, before = [], np.zeros(len(self.paths), np.int64)
        for k in range(self.paths.shape[1]):
            new[1:] |= self.paths[1:, k] != self.paths[:-1, k]
            here = new & (self.paths[:, k] > 0)
            at = np.flatnonzero(here)
            out.append((at, before[at]))
            before = np.cumsum(here) - 1
        return out

    def pack(self) -> bytes:
        """Arcs and weights of all states, depth by depth."""
        used = np.zeros(len(self.words) + 1, bool)
        used[self.paths.ravel()] = True
        used[0] = False
        kept = np.flatnonzero(used)
        renamed = np.cumsum(used)
        words = [self.words[k - 1] for k in kept.tolist()]
        arrays = [np.array([len(w) for w in words], np.int64), np.frombuffer(b"".join(words), np.uint8)]
        width = self.paths.shape[1]
        ends = (self.paths > 0).sum(1)
        above = 1
        for k, (at, source) in enumerate(self.states()):
            arrays += [renamed[self.paths[at, k]], np.bincount(source, minlength=above), np.where(ends[at] == k + 1, self.weights[at], 0)]
            above = len(at)
        parts_ = [np.array([len(arrays), width], np.int64).tobytes()]
        for a in arrays:
            small = a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(a) or int(a.max()) <= np.iinfo(t).max))
            parts_ += [np.array([small.itemsize, len(small)], np.int64).tobytes(), small.tobytes()]
        raw = b"".join(parts_)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)

    @classmethod
    def unpack(cls, blob: bytes) -> Automaton:
        raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
        count, width = np.frombuffer(raw, np.int64, 2).tolist()
        at, arrays = 16, []
        for _ in range(count):
            size, n = np.frombuffer(raw, np.int64, 2, at).tolist()
            arrays.append(np.frombuffer(raw, f"u{size}", n, at + 16).astype(np.int64))
            at += 16 + size * n
        ends = np.cumsum(arrays[0]).tolist()
        text = arrays[1].astype(np.uint8).tobytes()
        words = [text[a:b] for a, b in zip([0, *ends], ends)]
        labels, children, weights = (arrays[2 + k :: 3] for k in range(3))
        above = [np.repeat(np.arange(len(c)), c) for c in children]
        # paths below each state, itself included, from the deepest on; then the place of each state's own path
        below = [(w > 0).astype(np.int64) for w in weights]
        for k in range(width - 1, 0, -1):
            below[k - 1] += np.bincount(above[k], below[k], len(below[k - 1])).astype(np.int64)
        paths = np.zeros((int(below[0].sum()), width), np.int32)
        found = np.zeros(len(paths), np.int64)
        so_far, start = np.zeros((1, 0), np.int32), np.zeros(1, np.int64)
        for k in range(width):
            so_far = np.concatenate([so_far[above[k]], labels[k][:, None].astype(np.int32)], 1)
            earlier = np.cumsum(below[k]) - below[k]
            eldest = np.cumsum(children[k]) - children[k]
            own = (weights[k - 1] > 0) if k else np.zeros(1, bool)
            start = (start + own)[above[k]] + earlier - earlier[eldest[above[k]]]
            last = weights[k] > 0
            paths[start[last], : k + 1] = so_far[last]
            found[start[last]] = weights[k][last]
        return cls(words, paths, found)

    def place(self, path: Sequence[bytes]) -> int:
        """How many paths come before ``path``."""
        low, high = 0, len(self.paths)
        for k, word in enumerate(path):
            n = bisect.bisect_left(self.words, word)
            column = self.paths[low:high, k]
            low, high = low + int(np.searchsorted(column, n + 1)), low + int(np.searchsorted(column, n + 1, "right"))
            if n == len(self.words) or self.words[n] != word:
                return low
        return low

    def spelled(self, path: Sequence[int]) -> list[bytes]:
        return [self.words[k - 1] for k in path if k]


def _keys(paths: np.ndarray, words: int) -> list[np.ndarray]:
    """Several columns of a path a key, so fewer keys are sorted by."""
    bits = 21 if words < (1 << 21) - 1 else 31
    step = 63 // bits
    out = []
    for k in range(0, paths.shape[1], step):
        key = paths[:, k].astype(np.int64)
        for j in range(k + 1, min(k + step, paths.shape[1])):
            key = key << bits | paths[:, j]
        out.append(key)
    return out


def united(automata: Sequence[Automaton]) -> Automaton:
    """One automaton with the summed weights of all."""
    if len(automata) == 1:
        return automata[0]
    words = sorted(set().union(*(a.words for a in automata)))
    number = {w: n for n, w in enumerate(words, 1)}
    paths = [np.array([0, *(number[w] for w in a.words)], np.int32)[a.paths] for a in automata]
    return Automaton.sorted(words, np.concatenate(paths), np.concatenate([a.weights for a in automata]))


def _of_slice(data: np.ndarray, at: np.ndarray, group: np.ndarray, longest: int) -> Iterator[tuple[int, Automaton]]:
    """The automaton of each group of texts."""
    data = lowered(data)
    start, size, counts = runs(data, at, _INSIDE)
    if not len(start):
        return
    ids, words = distinct(data, start, size)
    breaks = np.cumsum(_APART[data], dtype=np.int32)[start]
    text = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(start), bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    end = np.repeat(np.append(first[1:], len(start)), np.diff(np.append(first, len(start))))
    left = end - np.arange(len(start))
    padded = np.append(ids + 1, np.zeros(longest, np.int64)).astype(np.int32)
    paths = np.stack([np.where(k < left, padded[k : k + len(ids)], 0) for k in range(longest)], 1)
    named = np.repeat(group, counts)
    for g in np.unique(named).tolist():
        mine = paths[named == g]
        used = np.zeros(len(words) + 1, bool)
        used[mine[:, 0]] = True
        renamed = np.where(used, np.cumsum(used), 0).astype(np.int32)
        yield g, Automaton.sorted([words[k - 1] for k in np.flatnonzero(used).tolist()], renamed[mine], np.ones(len(mine), np.int64))


SHARDS = "lang string, n bigint, offered array<array<binary>>, shard binary"


def _shards(longest: int, limit: int):
    def row(lang: str, automaton: Automaton) -> tuple:
        # each offered path stands for as many, whatever shard it is from
        step = -(-limit // OFFERED)
        offered = [automaton.spelled(p) for p in automaton.paths[step // 2 :: step].tolist()]
        return lang, len(automaton.paths), offered, automaton.pack()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[Automaton]] = {}
        for batch in batches:
            langs, codes = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            for data, at, owner in parts(batch, _APART):
                for g, automaton in _of_slice(data, at, codes[owner], longest):
                    waiting.setdefault(str(langs[g]), []).append(automaton)
                while sum(len(a.paths) for found in waiting.values() for a in found) > limit:
                    # unite the largest language; store it if that doesn't make room
                    lang = max(waiting, key=lambda k: sum(len(a.paths) for a in waiting[k]))
                    one = united(waiting[lang])
                    waiting[lang] = [one]
                    if sum(len(a.paths) for found in waiting.values() for a in found) > limit // 2:
                        yield _rows([row(lang, one)], SHARDS)
                        del waiting[lang]
        for lang, found in waiting.items():
            yield _rows([row(lang, united(found))], SHARDS)
    return run


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<array<binary>>": pa.list_(pa.list_(pa.binary()))}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def borders(sample: list[tuple[str, tuple[bytes, ...]]], n: int) -> dict[str, list[tuple[bytes, ...]]]:
    """Per language the paths with which ``n`` ranges of about equal size begin; the first range begins with all languages."""
    sample = sorted(sample)
    chosen = sorted({sample[k * len(sample) // n] for k in range(1, n)}) if sample else []
    out: dict[str, list[tuple[bytes, ...]]] = {}
    for lang, path in chosen:
        out.setdefault(lang, []).append(path)
    return out


PARTS = "lang string, part int, shard binary"


def _parts(found):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = Automaton.unpack(blob.as_py())
                cuts = [0, *(whole.place(b) for b in found.value.get(lang, [])), len(whole.paths)]
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        part = Automaton(whole.words, whole.paths[a:b], whole.weights[a:b])
                        yield _rows([(lang, n, part.pack())], PARTS)
    return run


COUNTS = "lang string, words int, phrase string, f bigint"


def _counted(at_least: int, limit: int):
    """Phrases of a range and how often they occur: frequent ones, those at its borders, and the empty phrase."""

    def run(table: pa.Table) -> pa.Table:
        whole: list[Automaton] = []
        for blob in table.column("shard"):
            whole.append(Automaton.unpack(blob.as_py()))
            if len(whole) > 1 and sum(len(a.paths) for a in whole[1:]) > limit // 4 + len(whole[0].paths):
                whole = [united(whole)]
        one = united(whole)
        del whole
        lang = table.column("lang")[0].as_py()
        out = [(lang, 0, "", int(one.weights.sum()))]
        sums = np.concatenate(([0], np.cumsum(one.weights)))
        first = np.zeros(len(one.paths), bool)
        first[:1] = True
        for k in range(one.paths.shape[1]):
            first[1:] |= one.paths[1:, k] != one.paths[:-1, k]
            at = np.flatnonzero(first)
            end = np.append(at[1:], len(first))
            f = sums[end] - sums[at]
            keep = ((f >= at_least) | (at == 0) | (end == len(first))) & (one.paths[at, k] > 0)
            for p, n in zip(one.paths[at[keep], : k + 1].tolist(), f[keep].tolist()):
                out.append((lang, k + 1, b" ".join(one.spelled(p)).decode(), n))
        return pa.Table.from_batches([_rows(out, COUNTS)])
    return run


def counts(docs: DataFrame, at_least: int, longest: int = LONGEST, shard: int = SHARD, size: int = RANGE) -> DataFrame:
    """``lang, words, phrase, f`` of all phrases of at most ``longest`` words that occur ``at_least`` times; the empty phrase counts all words."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shards = stored(rows.mapInArrow(_shards(longest, shard), SHARDS), "shards")
    total, paths = (int(x or 0) for x in shards.agg(F.sum("n"), F.sum(F.size("offered"))).first())
    n = min(-(-total // size), RANGES) or 1
    # at most about SAMPLED * RANGES paths come to the driver
    share = min(1.0, 2.0 * SAMPLED * n / max(paths, 1))
    offered = shards.select("lang", F.explode("offered").alias("path")) if n > 1 else None
    offered = offered.where(F.pmod(F.xxhash64("lang", "path"), F.lit(1 << 30)) < share * (1 << 30)) if n > 1 else None
    sample = [(r.lang, tuple(map(bytes, r.path))) for r in offered.toLocalIterator()] if n > 1 else []
    found = docs.sparkSession.sparkContext.broadcast(borders(sample, n))
    cut = shards.select("lang", "shard").mapInArrow(_parts(found), PARTS)
    counted = cut.groupBy("lang", "part").applyInArrow(_counted(at_least, size), COUNTS)
    summed = stored(counted, "counted").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return stored(summed.where((F.col("f") >= at_least) | (F.col("words") == 0)), "counts")


def _part(words: int, begin: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), begin, n), " ")


def _looked_up(rows: DataFrame, counted: DataFrame, part: str, name: str) -> DataFrame:
    """``rows`` with the count of the phrase in column ``part`` of their language."""
    times = rows.groupBy("lang", part).agg(F.count("*").alias("n"))
    named = counted.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)).join(times, ["lang", part])
    return attach(rows, stored(named, "parts"), ["lang", part], rows.count())


def collocations(docs: DataFrame, at_least: int = 100, first: int = 2000, longest: int = LONGEST, shard: int = SHARD, size: int = RANGE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` phrases of each language whose words belong together most.

    A phrase's score is that of its weakest cut into two parts.  Phrases that only occur inside a longer one are left out.
    """
    counted = counts(docs, at_least, longest, shard, size)
    phrases = counted.where("words > 1")
    within = counted.where("words > 2").select("lang", "f", F.explode(F.array(
        _part(0, F.lit(1), F.col("words") - 1), _part(0, F.lit(2), F.col("words") - 1))).alias("phrase"))
    covered = within.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    open_ = phrases.join(covered, ["lang", "phrase"], "left").where("longer is null or longer < f")
    cuts = open_.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = stored(cuts.select(
        "lang", "phrase", "a", "k", _part(0, F.lit(1), F.col("k")).alias("begin"),
        _part(0, F.col("k") + 1, F.col("words") - F.col("k")).alias("end")), "cuts")
    both = stored(_looked_up(cuts, counted, "begin", "l"), "begins")
    both = _looked_up(both, counted, "end", "r")
    totals = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    # one row a language
    scored = both.join(totals, "lang").withColumn(
        "score", F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    least = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s")).select("lang", "phrase", "s.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranks = least.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
    return ranks.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
