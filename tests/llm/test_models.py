"""Classifiers: held-out quality, exact inference, odd and empty tables."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from cveflow.llm import co_training, language_crf, queries, toxicity
from cveflow.llm.frames import held_out


@pytest.fixture(scope="module")
def known(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def _share(df, condition):
    rows = df.collect()
    return sum(map(condition, rows)) / len(rows)


def test_toxicity_of_held_out_documents(spark, known):
    found = queries.op8_toxicity(spark, "/root/testdata/sf0.01")
    assert found.count() == 1000 and found.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    unseen = found.where("held_out").join(known, "doc_id").cache()
    assert _share(unseen, lambda r: r.predicted == r.toxic) > 0.9
    assert _share(unseen.where("toxic = 1"), lambda r: r.predicted == 1) > 0.5


def test_toxicity_counts_a_feature_once_per_document():
    weights, squares = np.zeros(1 << toxicity.BITS, np.float32), np.zeros(1 << toxicity.BITS, np.float32)
    feature = int(toxicity.hashes("bad")[0][0])
    weights[feature], squares[feature] = 3.0, 4.0
    once = toxicity.score_texts(["bad", "bad bad bad", "ba", "", "BAD"], weights, squares, -1.0)
    want = 1 / (1 + np.exp(-(3 / np.sqrt(toxicity.SMOOTH + 4) - 1)))
    none = 1 / (1 + np.exp(1.0))
    assert np.allclose(once, [want, want, none, none, want])
    # an n-gram doesn't reach into the next text
    assert np.allclose(toxicity.score_texts(["ba", "d"], weights, squares, -1.0), none)


def test_toxicity_of_odd_rows(odd, none, labels):
    found = toxicity.toxicity(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.predicted for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0}


def test_quality_of_held_out_documents(spark, known):
    found = queries.op2_quality(spark, "/root/testdata/sf0.01")
    assert found.count() == 1000
    unseen = found.where("held_out").join(known, "doc_id").cache()
    assert _share(unseen, lambda r: r.keep == (r.quality == 1)) > 0.85
    assert _share(unseen.where("quality = 1"), lambda r: r.keep) > 0.93


def test_views_of_texts():
    content, meta = co_training.views(["Abc 12.\nx", "", "abc", "é" * 3], ["s", None, "s", "t"], [None, "en", "en", "en"])
    flags = np.unpackbits(content, axis=1)
    assert flags.sum(1).tolist() == [7, 0, 1, 1]
    assert meta.shape == (4, len(co_training.METADATA))
    assert meta[0, 0] == meta[2, 0] != meta[1, 0] and meta[1, 1] == meta[2, 1] != meta[0, 1]
    assert meta[0, 5] > 0 and meta[2, 5] == 0


def test_view_counts_and_calibration():
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 4000)
    flags = rng.random((4000, 20)) < np.where(label[:, None] == 1, 0.4, 0.3)
    zero, one, n = co_training._by_label(flags, label)
    view = co_training.View(np.stack((zero, one)), n)
    bins = co_training.score_bin(view.raw(flags))
    view.calibrate(np.bincount(label * co_training.SCORE_BINS + bins, minlength=2 * co_training.SCORE_BINS).reshape(2, -1))
    chance = 1 / (1 + np.exp(-view.odds(flags)))
    assert abs(chance.mean() - label.mean()) < 0.03
    sure = chance > 0.7
    assert abs(label[sure].mean() - chance[sure].mean()) < 0.08


def test_quality_of_odd_rows(odd, none, labels):
    found = co_training.quality(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in found)
    assert co_training.quality(none, labels).count() == 0
    assert {(r.score, r.keep) for r in co_training.quality(odd, labels.limit(0)).collect()} == {(0.5, True)}


def test_language_of_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = queries.op10_language(spark, "/root/testdata/sf0.01")
    assert found.count() == 1000
    assert _share(found.where("held_out").join(table, "doc_id"), lambda r: r.lang == r.lang_pred) > 0.97


def test_forward_backward_equals_enumeration():
    rng, k = np.random.default_rng(0), 3
    emission, first, move = rng.normal(size=(9, k)), rng.normal(size=k), rng.normal(size=(k, k))
    start, size = np.array([0, 4, 5]), np.array([4, 1, 4])
    found, moves = language_crf.forward_backward(emission, start, size, first, move)
    want, want_moves = np.zeros((9, k)), np.zeros((k, k))
    for a, n in zip(start, size):
        total, word, pair = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=int(n)):
            p = np.exp(first[path[0]] + sum(emission[a + i, y] for i, y in enumerate(path)) + sum(move[x, y] for x, y in itertools.pairwise(path)))
            total += p
            for i, y in enumerate(path):
                word[i, y] += p
            for x, y in itertools.pairwise(path):
                pair[x, y] += p
        want[a : a + n] = word / total
        want_moves += pair / total
    assert np.allclose(found, want) and np.allclose(moves, want_moves)


def test_segments_cover_all_words():
    sizes = np.array([0, 1, 64, 65, 200, 0])
    start, size = language_crf.segments(sizes)
    assert sorted(x for a, n in zip(start, size) for x in range(a, a + n)) == list(range(sizes.sum()))
    assert size.max() == language_crf.SEGMENT


def test_code_switched_words(docs):
    crf = language_crf.train(docs)
    by_lang = {r.lang: r.text for r in docs.orderBy("doc_id").collect()}
    one, two = (language_crf.words(by_lang[x])[:20] for x in ("en", "de"))
    seen, sizes = language_crf.Scores(crf).label([" ".join(one + two)])
    found = [crf.langs[i] for i in seen.argmax(1)]
    want = ["en"] * len(one) + ["de"] * len(two)
    assert sizes.tolist() == [len(want)] and sum(a == b for a, b in zip(found, want)) >= 0.85 * len(want)
    again = language_crf.Crf.unpack(crf.langs, crf.pack())
    assert np.allclose(again.weights, crf.weights) and np.allclose(again.move, crf.move)


def test_language_of_odd_rows(odd, none):
    found = language_crf.identify(odd, language_crf.train(odd)).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    for r in found:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not language_crf.words(texts[r.doc_id] or ""))
    assert language_crf.identify(none, language_crf.train(none)).count() == 0
    assert {r.lang_pred for r in language_crf.identify(odd, language_crf.train(none)).collect()} == {"und"}


def test_held_out_is_a_quarter(spark):
    rows = spark.range(8000).select(held_out("id").alias("out"))
    assert 0.22 < rows.where("out").count() / 8000 < 0.28
