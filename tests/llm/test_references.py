"""The three classifiers against plain references: counts, ratios, fits, pseudo-labels, calibration, gradients, decisions."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from cveflow.llm import co_training, language_crf, toxicity
from odd_tables import make


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.asarray(x)))


# --- Toxicity ---

def _grams(text):
    """Hashed n-grams of a text, one by one."""
    low = text.lower()
    return {int(toxicity.hashes(low[i : i + n])[k][0]) for k, n in enumerate((3, 4, 5)) for i in range(len(low) - n + 1)}


def _toxic_reference(texts, label, total):
    """Dense fit on the given texts: ratios of shares, then gradient steps with moments over scaled columns."""
    sets = [_grams(t) for t in texts]
    n = [label.count(0), label.count(1)]
    ratio = {}
    for g in set().union(*sets):
        c = [sum(g in s for s, y in zip(sets, label) if y == k) for k in (0, 1)]
        pooled = (sum(c) + 1) / (sum(n) + 2)
        error = math.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
        if sum(c) >= toxicity.LEAST_DOCS and abs(c[1] / n[1] - c[0] / n[0]) >= toxicity.LEAST_ERRORS * error:
            ratio[g] = math.log((c[1] + 1) / (n[1] + 2)) - math.log((c[0] + 1) / (n[0] + 2))
    kept = sorted(ratio)

    def row(s):
        values = np.array([ratio[g] if g in s else 0.0 for g in kept])
        return values / math.sqrt(toxicity.SMOOTH + (values**2).sum())

    x, y = np.stack([row(s) for s in sets]), np.array(label, float)
    weight = np.array([total[k] / n[k] for k in label])
    weight /= weight.sum()
    w, bias = np.zeros(len(kept)), math.log((weight * y).sum() / (1 - (weight * y).sum()))
    one, two = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, toxicity.ROUNDS + 1):
        gap = weight * (_sigmoid(x @ w + bias) - y)
        slope = np.append(x.T @ gap + toxicity.DECAY * w, gap.sum())
        one, two = 0.9 * one + 0.1 * slope, 0.999 * two + 0.001 * slope**2
        step = toxicity.STEP * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return lambda text: float(_sigmoid(row(_grams(text)) @ w + bias))


def test_toxicity_equals_a_dense_fit(spark):
    rng = random.Random(2)
    bad, good = ["vile", "rotten", "hateful"], ["kind", "gentle", "sunny"]
    texts, toxic = [], []
    for i in range(160):
        y = int(rng.random() < 0.4)
        texts.append(" ".join(rng.choice((bad if y else good) if rng.random() < 0.5 else ["the", "a", "of", "word", "Ä"]) for _ in range(9)))
        toxic.append(y)
    docs = make(spark, [*texts, None, "", "ab"])
    rows = [(i, None, y) for i, y in enumerate(toxic)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    seen = [i for i in range(160) if not _held_out(i)]
    total = [sum(toxic[i] == k for i in seen) for k in (0, 1)]
    reference = _toxic_reference([texts[i] for i in seen], [toxic[i] for i in seen], total)
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    for i, t in enumerate([*texts, "", "", "ab"]):
        assert abs(found[i].score - reference(t)) < 2e-4 and found[i].held_out == _held_out(i), (i, found[i].score, reference(t))
    # labels of held-out rows are never read
    flipped = spark.createDataFrame([(i, None, 1 - y if _held_out(i) else y) for i, y in enumerate(toxic)], "doc_id bigint, quality int, toxic int")
    assert {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()} == {i: r.score for i, r in found.items()}


# --- Quality ---

class _PlainView:
    def __init__(self, flags, label):
        n = [label.count(0), label.count(1)]
        counts = {}
        for row, y in zip(flags, label):
            for f in np.flatnonzero(row).tolist():
                counts.setdefault(f, [0, 0])[y] += 1
        self.ratio = {f: math.log((c[1] + 0.5) / (n[1] + 1)) - math.log((c[0] + 0.5) / (n[0] + 1)) for f, c in counts.items()}
        self.unseen = math.log(0.5 / (n[1] + 1)) - math.log(0.5 / (n[0] + 1))

    def raw(self, row):
        some = np.flatnonzero(row).tolist()
        return sum(self.ratio.get(f, self.unseen) for f in some) / math.sqrt(max(len(some), 1))

    def calibrate(self, raws, label):
        """Newton steps on the rows themselves, each at the middle of its bin."""
        bins = [min(int((math.tanh(r / co_training.SPREAD) + 1) / 2 * co_training.SCORE_BINS), co_training.SCORE_BINS - 1) for r in raws]
        x = np.array([math.atanh(min(max((b + 0.5) / co_training.SCORE_BINS * 2 - 1, -0.999), 0.999)) * co_training.SPREAD for b in bins])
        y, theta = np.array(label, float), np.array([1.0, 0.0])
        for _ in range(200):
            p = _sigmoid(np.clip(theta[0] * x + theta[1], -30, 30))
            slope = np.array([((p - y) * x).sum() + 1e-2 * (theta[0] - 1), (p - y).sum() + 1e-2 * theta[1]])
            q = p * (1 - p)
            curve = np.array([[(q * x * x).sum() + 1e-2, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-2]])
            step = np.linalg.solve(curve, slope)
            theta = theta - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
            theta[0] = max(theta[0], 1e-3)
        self.scale, self.bias = theta


def _quality_reference(rows, rounds):
    """``rows``: (content flags, metadata flags, label or None, fold)."""
    low, high = (math.log(p / (1 - p)) for p in co_training.SURE)

    def learn(taught):
        both = []
        for v in (0, 1):
            some = [i for i, t in enumerate(taught[v]) if t is not None]
            view = _PlainView(np.stack([rows[i][v] for i in some]), [taught[v][i] for i in some])
            known = [i for i, r in enumerate(rows) if r[3] == 3 and r[2] is not None]
            view.calibrate([view.raw(rows[i][v]) for i in known], [rows[i][2] for i in known])
            both.append(view)
        return both

    def odds(view, row):
        return view.scale * view.raw(row) + view.bias

    own = [r[2] if r[3] in (0, 1) else None for r in rows]
    both = learn([own, own])
    pseudo = 0
    for _ in range(rounds):
        taught = []
        for v in (0, 1):
            other = both[1 - v]
            labels = []
            for i, r in enumerate(rows):
                if r[2] is None:
                    o = odds(other, r[1 - v])
                    labels.append(1 if o >= high else 0 if o <= low else None)
                    pseudo += labels[-1] is not None
                else:
                    labels.append(own[i])
            taught.append(labels)
        both = learn(taught)
    known = [y for y in own if y is not None]
    prior = math.log(known.count(1) / known.count(0))
    out = []
    for r in rows:
        a, b = odds(both[0], r[0]), odds(both[1], r[1])
        out.append(tuple(float(_sigmoid(np.clip(z, -50, 50))) for z in (a, b, a + b - prior)))
    return out, pseudo


def test_quality_equals_plain_co_training(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(220):
        y = int(rng.random() < 0.6)
        words = ["fine", "text", "reads", "well"] if y else ["zzqx", "1234", "###", "CLICK"]
        text = " ".join(rng.choice(words if rng.random() < 0.8 else ["and", "so"]) for _ in range(rng.randrange(3, 12)))
        rows.append((i, text, rng.choice(["en", "de"]), f"s{y if rng.random() < 0.8 else 1 - y}", 0))
        if rng.random() < 0.7:
            labels.append((i, y, None))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    content, meta = co_training.views([r[1] for r in rows], [r[3] for r in rows], [r[2] for r in rows])
    flags = np.unpackbits(content, axis=1).astype(bool)
    known = {i: y for i, y, _ in labels}
    plain = []
    for r, f, m in zip(rows, flags, meta):
        wide = np.zeros(len(co_training.METADATA) * co_training.BINS, bool)
        wide[[k * co_training.BINS + int(b) for k, b in enumerate(m)]] = True
        plain.append((f, wide, None if _held_out(r[0]) else known.get(r[0]), zlib.crc32(str(r[0]).encode()) % 4))
    want, pseudo = _quality_reference(plain, co_training.ROUNDS)
    assert pseudo > 20
    for r in co_training.quality(docs, table).collect():
        got = (r.content_score, r.metadata_score, r.score)
        assert np.allclose(got, want[r.doc_id], atol=2e-3), (r.doc_id, got, want[r.doc_id])
        assert r.keep == (r.score >= co_training.KEEP)


# --- Language ---

def _log_total(emission, start, size, first, move):
    total = 0.0
    for a, n in zip(start, size):
        ahead = first + emission[a]
        for t in range(1, n):
            ahead = emission[a + t] + np.array([np.logaddexp.reduce(ahead + move[:, j]) for j in range(len(first))])
        total += np.logaddexp.reduce(ahead)
    return total


def test_gradient_equals_finite_differences():
    rng, k = np.random.default_rng(5), 3
    emission, first, move = rng.normal(size=(11, k)), rng.normal(size=k), rng.normal(size=(k, k))
    start, size = np.array([0, 6, 7]), np.array([6, 1, 4])
    seen, moves = language_crf.forward_backward(emission, start, size, first, move)
    for values, want in ((emission, seen), (first, seen[start].sum(0)), (move, moves)):
        slope = np.zeros_like(values)
        for at in np.ndindex(values.shape):
            both = []
            for sign in (1, -1):
                values[at] += sign * 1e-5
                both.append(_log_total(emission, start, size, first, move))
                values[at] -= sign * 1e-5
            slope[at] = (both[0] - both[1]) / 2e-5
        assert np.allclose(slope, want, atol=1e-6)


def test_a_fit_raises_the_likelihood_of_its_labels():
    docs = [(["la", "le", "les", "un"] * 6, 0), (["der", "die", "ein", "und"] * 6, 1)] * 4
    crf = language_crf.Crf.fit(["fr", "de"], docs)
    seen, sizes = language_crf.Scores(crf).label([" ".join(w) for w, _ in docs])
    label = np.repeat([y for _, y in docs], sizes)
    assert seen[np.arange(len(label)), label].min() > 0.9


def test_documents_are_decided_by_the_mean_of_their_words(docs):
    crf = language_crf.train(docs)
    rows = {r.doc_id: r.text for r in docs.limit(60).collect()}
    for r in language_crf.identify(docs.where(F.col("doc_id").isin(list(rows))), crf).collect():
        seen, sizes = language_crf.Scores(crf).label([rows[r.doc_id]])
        if not sizes[0]:
            assert (r.lang_pred, r.score, r.n_words) == ("und", 0.0, 0)
            continue
        mean = [sum(p[j] for p in seen.tolist()) / len(seen) for j in range(len(crf.langs))]
        best = max(range(len(mean)), key=mean.__getitem__)
        word = [max(range(len(p)), key=p.__getitem__) for p in seen.tolist()]
        assert r.lang_pred == crf.langs[best] and abs(r.score - mean[best]) < 1e-9 and r.n_words == len(seen)
        assert r.n_switches == sum(a != b for a, b in zip(word, word[1:]))
