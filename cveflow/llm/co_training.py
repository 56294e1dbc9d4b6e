"""Quality of documents by two classifiers that teach each other.

The content view of a document is the set of its character trigrams, hashed; the metadata view is its source,
language, size and layout, in bins.  Each view has a naive Bayes classifier, learnt from counts alone.  In
every round each view scores all documents, its scores are calibrated on labelled documents
that it hasn't learnt from, and the unlabelled documents of which it is sure become pseudo-labelled
examples of the other view.  After ``ROUNDS`` rounds the calibrated log odds of both views are added.

Everything that is learnt is a sum over all documents, so each round is one pass over the stored
features whose tasks return counts of bounded size.  Of the labelled documents a quarter is held out
(see ``held_out``), a quarter calibrates and half is learnt from.

Nulls: a null text counts as empty, a null source or language is a bin of its own; labels that are
null or not 0 or 1, or have a null id, are ignored.  Without both labels every score is 0.5 and all
documents stay.  Every row is scored by itself, so equal texts with equal metadata score the same; a score of
exactly ``KEEP`` stays.  A very long text is read whole, a set of at most 2^BITS trigrams.  An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cveflow.llm.arrow import offsets, slices
from cveflow.llm.frames import held_out
from cveflow.scratch import stored

BITS = 13
ROUNDS = 2
#: Chance above which a view teaches a document to the other as good, and below which as bad.
SURE = (0.03, 0.97)
KEEP = 0.5
#: Bins of every metadata feature, and of the scores for calibration.
BINS = 32
SCORE_BINS = 256
SLICE_ROWS = 1024
METADATA = ("source", "lang", "chars", "lines", "words_per_line", "upper", "lower", "digits", "space", "signs")
#: Kinds of characters: upper and lower case, digit, space, line end, other.
UPPER, LOWER, DIGIT, SPACE, LINE, SIGN = range(6)

_KIND = np.full(0x250, SIGN, np.uint8)
for _c in range(0x250):
    _general = unicodedata.category(chr(_c))
    _KIND[_c] = {"Lu": UPPER, "Ll": LOWER, "Lo": LOWER, "Nd": DIGIT, "Zs": SPACE}.get(_general, SIGN)
_KIND[9], _KIND[10] = SPACE, LINE


def _per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    summed = np.concatenate(([0], np.cumsum(values)))
    return summed[ends] - summed[np.append(0, ends[:-1])]


def views(batch: list[str], source: list, lang: list) -> tuple[np.ndarray, np.ndarray]:
    """Packed trigram flags and metadata bins of all texts."""
    chars = np.frombuffer("".join(batch).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) for t in batch])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(batch)), sizes)
    flags = np.zeros((len(batch), 1 << BITS), bool)
    if len(chars) > 2:
        mixed = chars * np.uint32(0x85EBCA6B)
        x = (mixed[:-2] * np.uint32(0x01000193) ^ mixed[1:-1]) * np.uint32(0x01000193) ^ mixed[2:]
        x = ((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
        inside = owner[:-2] == owner[2:]
        flags[owner[:-2][inside], x[inside]] = True
    kind = _KIND[np.minimum(chars, 0x24F)]
    kind[chars >= 0x250] = LOWER
    counts = [_per_text(kind == k, ends) for k in range(6)]
    blank = (kind == SPACE) | (kind == LINE)
    begins = ~blank
    begins[1:] &= blank[:-1] | (owner[1:] != owner[:-1])
    size = np.maximum(sizes, 1)

    def share(k):
        return np.minimum(np.sqrt(counts[k] / size) * BINS, BINS - 1).astype(int)

    def log(x):
        return np.minimum(np.log2(1 + x) * 1.5, BINS - 1).astype(int)

    def named(values):
        return np.array([0 if v is None else 1 + zlib.crc32(v.encode()) % (BINS - 1) for v in values], int)

    lines = counts[LINE] + 1
    bins = [named(source), named(lang), log(sizes), log(lines), log(_per_text(begins, ends) / lines),
            *(share(k) for k in (UPPER, LOWER, DIGIT, SPACE, SIGN))]
    return np.packbits(flags, axis=1), np.stack(bins, 1).astype(np.uint8) if len(batch) else np.zeros((0, len(METADATA)), np.uint8)


def _features(docs: DataFrame) -> DataFrame:
    """``doc_id, content, metadata`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, rows=SLICE_ROWS):
                content, meta = views(*(batch.column(c).to_pylist() for c in ("text", "source", "lang")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([r.tobytes() for r in content], pa.binary()),
                     pa.array([r.tobytes() for r in meta], pa.binary())], ["doc_id", "content", "metadata"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("source").cast("string"), F.col("lang").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, content binary, metadata binary")


def _rows(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1), np.uint8)
    at = offsets(column)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(len(column), -1)


class View:
    """Naive Bayes over flags: log ratio of each flag, and the calibration of the mean ratio of a document."""

    def __init__(self, counts: np.ndarray, totals: np.ndarray):
        shares = (counts + 0.5) / (totals[:, None] + 1)
        self.ratio = (np.log(shares[1]) - np.log(shares[0])).astype(np.float32)
        self.scale, self.bias = 1.0, 0.0

    def raw(self, flags: np.ndarray) -> np.ndarray:
        """Mean log ratio of the flags that are set, by the root of their number."""
        present = flags.sum(1, dtype=np.int64)
        return (flags.astype(np.float32) @ self.ratio) / np.sqrt(np.maximum(present, 1))

    def odds(self, flags: np.ndarray) -> np.ndarray:
        return self.scale * self.raw(flags) + self.bias

    def calibrate(self, counts: np.ndarray) -> None:
        """Logistic regression of the label on the raw score, from counts of score bins (row: label)."""
        middle = (np.arange(SCORE_BINS) + 0.5) / SCORE_BINS * 2 - 1
        x = np.arctanh(np.clip(middle, -0.999, 0.999)) * SPREAD
        scale, bias = 1.0, 0.0
        n, good = counts.sum(0), counts[1]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(scale * x + bias, -30, 30)))
            weight = n * p * (1 - p)
            slope = np.array([((n * p - good) * x).sum() + 1e-2 * (scale - 1), (n * p - good).sum() + 1e-2 * bias])
            curve = np.array([[(weight * x * x).sum() + 1e-2, (weight * x).sum()], [(weight * x).sum(), weight.sum() + 1e-2]])
            step = np.linalg.solve(curve, slope)
            step *= min(1.0, 2.0 / np.abs(step).max(initial=1e-9))
            scale, bias = max(scale - step[0], 1e-3), bias - step[1]
        self.scale, self.bias = float(scale), float(bias)


SPREAD = 8.0


def score_bin(raw: np.ndarray) -> np.ndarray:
    """Bin of a raw score; bins are finer near 0."""
    return np.minimum((np.tanh(raw / SPREAD) + 1) / 2 * SCORE_BINS, SCORE_BINS - 1).astype(int)


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Flags of both views."""
    content = np.unpackbits(_rows(batch.column("content")), axis=1).astype(bool)
    bins = _rows(batch.column("metadata"))
    meta = np.zeros((batch.num_rows, len(METADATA) * BINS), bool)
    if batch.num_rows:
        meta[np.arange(batch.num_rows)[:, None], np.arange(len(METADATA)) * BINS + bins] = True
    return content, meta


SIZES = (1 << BITS, len(METADATA) * BINS)


def _pass(rows: DataFrame, count, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Sums over all rows of the count arrays ``count(flags, label, fold)`` returns; ``sizes`` are their lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(sizes), np.int64)
        for whole in batches:
            for batch in (whole.slice(i, SLICE_ROWS) for i in range(0, whole.num_rows, SLICE_ROWS)):
                total += np.concatenate(count(_flags(batch), np.asarray(batch.column("label")), np.asarray(batch.column("fold"))))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    # at most sum(sizes) rows
    summed = rows.select("content", "metadata", "label", "fold").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(sum(sizes), np.int64)
    for r in summed.collect():
        out[r.at] = r.n
    return np.split(out, np.cumsum(sizes)[:-1])


def _by_label(flags: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Count of each flag among rows of label 0 and 1, and the numbers of rows."""
    each = [flags[label == y].sum(0, dtype=np.int64) for y in (0, 1)]
    return [*each, np.array([(label == 0).sum(), (label == 1).sum()])]


def _learn(rows: DataFrame, teach) -> tuple[View, View]:
    """Both views from counts of the labels that ``teach(flags, label, fold)`` gives each of them (-1: none)."""
    def count(flags, label, fold):
        return [c for f, y in zip(flags, teach(flags, label, fold)) for c in _by_label(f, y)]

    sums = _pass(rows, count, tuple(x for s in SIZES for x in (s, s, 2)))
    return tuple(View(np.stack(sums[i : i + 2]), sums[i + 2]) for i in (0, 3))


def _calibrate(rows: DataFrame, both: tuple[View, View]) -> None:
    """Fit each view's calibration on the calibrating quarter of the labelled rows."""
    def count(flags, label, fold):
        known = (fold == 3) & (label >= 0)
        return [np.bincount(label[known] * SCORE_BINS + score_bin(v.raw(f[known])), minlength=2 * SCORE_BINS) for v, f in zip(both, flags)]

    for view, sums in zip(both, _pass(rows, count, (2 * SCORE_BINS,) * 2)):
        view.calibrate(sums.reshape(2, -1))


def train(rows: DataFrame, rounds: int = ROUNDS) -> tuple[View, View]:
    """Both calibrated views after ``rounds`` rounds of mutual teaching; ``rows`` are features with ``label`` and ``fold``."""
    def own(flags, label, fold):
        return (np.where((fold == 0) | (fold == 1), label, -1),) * 2

    both = _learn(rows, own)
    _calibrate(rows, both)
    low, high = (float(np.log(p / (1 - p))) for p in SURE)
    for _ in range(rounds):
        def swapped(flags, label, fold, both=both):
            taught = []
            for view, f in zip(both[::-1], flags[::-1]):
                odds = view.odds(f)
                sure = np.where(odds >= high, 1, np.where(odds <= low, 0, -1))
                taught.append(np.where(label < 0, sure, np.where((fold == 0) | (fold == 1), label, -1)))
            return taught

        both = _learn(rows, swapped)
        _calibrate(rows, both)
    return both


def quality(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, content_score, metadata_score, score, keep`` of every document; scores are chances of label 1."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).dropDuplicates(["doc_id"])
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(0)).cast("int")
    visible = F.when(held_out(), -1).otherwise(F.coalesce("label", F.lit(-1)))
    rows = stored(_features(docs).join(known.hint("merge"), "doc_id", "left").select(
        "doc_id", "content", "metadata", visible.alias("label"), fold.alias("fold")), "views")
    classes = {r.label: r["count"] for r in rows.where("label >= 0 and fold in (0, 1)").groupBy("label").count().collect()}
    if len(classes) < 2:
        half = F.lit(0.5)
        return rows.select("doc_id", held_out().alias("held_out"), half.alias("content_score"), half.alias("metadata_score"), half.alias("score"), F.lit(True).alias("keep"))
    both = train(rows, rounds)
    prior = float(np.log(classes[1] / classes[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, SLICE_ROWS) for i in range(0, whole.num_rows, SLICE_ROWS)):
                odds = [v.odds(f) for v, f in zip(both, _flags(batch))]
                scores = [1 / (1 + np.exp(-np.clip(o, -50, 50))) for o in (*odds, odds[0] + odds[1] - prior)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(s.astype(np.float64)) for s in scores)],
                    ["doc_id", "content_score", "metadata_score", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "content", "metadata").mapInArrow(
        run, f"doc_id {kind}, content_score double, metadata_score double, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "content_score", "metadata_score", "score", (F.col("score") >= KEEP).alias("keep"))
