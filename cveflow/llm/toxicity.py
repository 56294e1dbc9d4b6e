"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A document is the set of its lower-cased character 3- to 5-grams, hashed.  From labelled documents each
n-gram gets the log ratio of its document counts in the two classes; n-grams whose counts could well
differ by chance are left out.  Logistic regression is fitted on the ratios of a document's n-grams,
scaled by their length, with class weights that restore the classes' shares.  The fit uses at most
about ``FIT`` labelled rows of each class and, for each class, half of ``FIT_FEATURES`` features, chosen by a hash of
the id: documents of about 3,200 different n-grams fill that with about 2,500 of a class.  Scoring reads every whole text.

Nulls: a null text counts as empty, which scores the prior; rows of labels with a null id or label are ignored.
Without both classes among the labels every score is the share of label 1 (0 without labels).  Repeated ids: every row is
scored by its own text; the fit takes the smallest text of an id, and one of its labels.  Equal texts score the same, however
often they occur.  A very long text is scored whole, a set of at most 2^20 features.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cveflow.llm.arrow import lists, offsets, slices
from cveflow.llm.frames import held_out, texts
from cveflow.scratch import stored

#: Labelled rows of each class that a fit uses, about, and features of all those rows together.
FIT = 6000
FIT_FEATURES = 16_000_000
ORDERS = (3, 4, 5)
BITS = 20
#: N-grams of fewer labelled documents, or whose shares in the classes differ by fewer standard errors, are left out.
LEAST_DOCS = 3
LEAST_ERRORS = 4.0
#: Added to a document's squared length, so that a single n-gram doesn't decide.
SMOOTH = 4.0
DECAY = 1e-4
ROUNDS = 60
STEP = 0.5
THRESHOLD = 0.3


def hashes(lowered: str) -> list[np.ndarray]:
    """Hashed n-grams at every place of a text, an array for each order."""
    chars = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
    mixed = (chars + np.uint32(0x7F4A7C15)) * np.uint32(0x85EBCA6B)
    rolled, out = mixed, []
    for n in range(2, max(ORDERS) + 1):
        if len(chars) < n:
            break
        rolled = (rolled[:-1] * np.uint32(0x01000193)) ^ mixed[n - 1 :]
        if n in ORDERS:
            x = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out.append(((x ^ (x >> np.uint32(13))) * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS))
    return out


def features(text: str, seen: np.ndarray) -> np.ndarray:
    """Distinct hashed n-grams of a text; ``seen`` is a cleared table of flags and is left so."""
    for part in hashes(text.lower()):
        seen[part] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def fit(rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weight and squared ratio of every feature, and the bias."""
    label, weight = label.astype(np.float64), weight / weight.sum()
    counts = np.zeros((2, 1 << BITS))
    for found, y in zip(rows, label.astype(int)):
        counts[y, found] += 1
    n = np.array([(label == 0).sum(), (label == 1).sum()])
    ratio = np.log((counts[1] + 1) / (n[1] + 2)) - np.log((counts[0] + 1) / (n[0] + 2))
    pooled = (counts.sum(0) + 1) / (n.sum() + 2)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n).sum())
    ratio[(counts.sum(0) < LEAST_DOCS) | (np.abs(counts[1] / n[1] - counts[0] / n[0]) < LEAST_ERRORS * error)] = 0
    place = np.cumsum(ratio != 0) - 1
    rows = [place[r[ratio[r] != 0]].astype(np.int32) for r in rows]
    scale = ratio[ratio != 0].astype(np.float32)
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    norm = np.sqrt(SMOOTH + np.bincount(owner, (scale * scale)[flat], len(rows)))
    w, share = np.zeros(len(scale)), float((weight * label).sum())
    bias = np.log(share / (1 - share))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, ROUNDS + 1):
        score = np.bincount(owner, (w * scale)[flat], len(rows)) / norm + bias
        gap = weight * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - label)
        slope = np.append(np.bincount(flat, (gap / norm)[owner], len(w)) * scale + DECAY * w, gap.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = STEP * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights = np.zeros(1 << BITS, np.float32)
    weights[ratio != 0] = w * scale
    return weights, (ratio * ratio).astype(np.float32), float(bias)


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str) -> tuple[DataFrame, dict[int, float]]:
    """Sampled rows of ``doc_id, label`` whose labels may be seen, and how many of each class may be."""
    seen = labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label"))
    seen = seen.where(~held_out() & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    total = {r.label: r["count"] for r in seen.groupBy("label").count().collect()}
    part = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000))
    share = {k: min(1.0, FIT / n) for k, n in total.items()}
    chosen = F.lit(False)
    for k, p in share.items():
        chosen = chosen | ((F.col("label") == k) & (part < int(1_000_000 * p) + 1))
    return seen.where(chosen).groupBy("doc_id").agg(F.min("label").alias("label")), total


def _fitting(sizes: list, room: int) -> dict[int, int]:
    """The last ``part`` of each class, in their order, with which its features are within ``room``."""
    last, left = {}, {}
    for r in sorted(sizes, key=lambda r: r.part):
        # a class ends with the first document that doesn't fit, so that short ones aren't preferred
        left[r.label] = left.get(r.label, room) - r.n
        if left[r.label] >= 0:
            last[r.label] = r.part
    return last


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of a classifier for ``label_col`` of ``labels``, fitted in one task on the bounded sample."""
    sample, total = _labelled(docs, labels, label_col)
    half = FIT_FEATURES // 2

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, bool)
        for whole in batches:
            for batch in slices(whole):
                rows = [features(t, seen) for t in batch.column("text").to_pylist()]
                at = np.cumsum([0, *map(len, rows)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part"), batch.column("label"), lists(np.concatenate(rows).astype(np.int32), at)],
                    ["part", "label", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, label = [], []
        for batch in batches:
            at, column = offsets(batch.column("features")), batch.column("features")
            values = np.asarray(column.values)
            rows += [values[a:b].copy() for a, b in zip(at[:-1], at[1:])]
            label += batch.column("label").to_pylist()
        label = np.array(label)
        if len(set(label)) < 2:
            return
        weights, squares, bias = fit(rows, label, np.array([total[y] / (label == y).sum() for y in (0, 1)])[label])
        model = [weights.tobytes(), squares.tobytes(), np.float64(bias).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2]), pa.array(model, pa.binary())], ["part", "data"])

    # at most about 2 * FIT ids, a text each
    rows = texts(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = stored(rows.select(F.xxhash64("doc_id").alias("part"), "label", "text"), "labelled")
    found = rows.mapInArrow(extract, "part bigint, label int, features array<int>")
    last = _fitting(found.select("part", "label", F.size("features").alias("n")).collect(), half)
    fits = F.lit(False)
    for k, part in last.items():
        fits = fits | ((F.col("label") == k) & (F.col("part") <= part))
    # cut before the shuffle, so the one task reads at most FIT_FEATURES
    model = rows.where(fits).mapInArrow(extract, found.schema).repartition(1).sortWithinPartitions("part").mapInArrow(learn, "part bigint, data binary").collect()
    if not model:
        share = rows.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        none = np.zeros(1 << BITS, np.float32)
        return none, none, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    data = {r.part: bytes(r.data) for r in model}
    return np.frombuffer(data[0], np.float32), np.frombuffer(data[1], np.float32), float(np.frombuffer(data[2])[0])


def score_texts(batch: list[str], weights: np.ndarray, squares: np.ndarray, bias: float) -> np.ndarray:
    """Score of each text."""
    lowered = [t.lower() for t in batch]
    ends = np.cumsum([len(t) for t in lowered])
    found = []
    for n, part in zip(ORDERS, hashes("".join(lowered))):
        at = np.flatnonzero(squares[part])
        text = np.searchsorted(ends, at, "right")
        whole = text == np.searchsorted(ends, at + n - 1, "right")
        found.append((text[whole] << BITS) | part[at[whole]])
    # an n-gram counts once for each document
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    text, feature = pairs >> BITS, pairs & ((1 << BITS) - 1)
    norm = np.sqrt(SMOOTH + np.bincount(text, squares[feature], len(batch)))
    return 1 / (1 + np.exp(-np.clip(np.bincount(text, weights[feature], len(batch)) / norm + bias, -50, 50)))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` and ``score`` of every document, higher where label 1 is likelier; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].tobytes(), model[1].tobytes(), model[2]))
    names = [*carry, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, squares = (np.frombuffer(b, np.float32) for b in shared.value[:2])
        for whole in batches:
            for batch in slices(whole):
                scores = score_texts([t or "" for t in batch.column("text").to_pylist()], weights, squares, shared.value[2])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(scores)], names)

    rows = docs.select(*carry, *([] if "text" in carry else ["text"]))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
