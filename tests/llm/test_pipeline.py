"""The pipeline stage by stage against plain Python."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from cveflow.llm import packing, toxicity
from cveflow.scratch import stored
from test_exact import _groups
from test_near import _brute

NAMES = ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """What goes into and comes out of every stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, sf_dir), name)
        out.append((docs, after))
        docs = after
    return dict(zip(NAMES, out))


def _rows(df):
    return sorted(tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect())


def test_stages_and_columns(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert all(tuple(results[n][1].columns) == corpus_pipeline.COLUMNS for n in NAMES[:-1])
    counts = [results["toxicity"][0].count(), *(results[n][1].count() for n in NAMES)]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > counts[2]


def test_toxic_documents_go(spark, sf_dir, results):
    before, after = results["toxicity"]
    gone = {r.doc_id for r in toxicity.toxicity(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()}
    assert gone and _rows(after) == [r for r in _rows(before) if r[0] not in gone]


def test_one_of_equal_texts_stays(results):
    before, after = results["exact_dedup"]
    keep = {r[0] for r in _groups([(r[0], r[1]) for r in _rows(before)]) if r[3]}
    assert _rows(after) == [r for r in _rows(before) if r[0] in keep]


def test_one_of_each_near_group_stays(results):
    before, after = results["near_dedup"]
    keep = {r[0] for r in _brute([(r[0], r[1]) for r in _rows(before)], 80) if r[3]}
    assert _rows(after) == [r for r in _rows(before) if r[0] in keep]


def test_personal_data_is_replaced(results):
    from test_exact import _base

    before, after = (_rows(df) for df in results["pii"])
    assert len(before) == len(after)
    for b, a in zip(before, after):
        if not _base(b[1]):
            assert a == b
        else:
            assert not _base(a[1]) and a[4] == len(a[1]) and "[" in a[1]


def test_all_documents_are_packed_by_tokens(results):
    before, after = results["packing"]
    rows = after.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in _rows(before))
    texts = {r[0]: r[1] for r in _rows(before)}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(r.n_tokens == len(model.encode(texts[r.doc_id] or "")) + 1 <= r.bucket_tokens for r in rows)
    batches = Counter()
    for r in rows:
        batches[r.batch_id] += r.bucket_tokens
    longest = Counter({r.batch_id: r.n_tokens for r in rows})
    assert all(n <= packing.BUDGET or n == longest[b] for b, n in batches.items())


def test_rows_go_by_their_own_text(spark, sf_dir, results):
    """Repeated ids with other texts, and rows without an id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    gone = toxicity.toxicity(docs, labels).where("predicted = 1").select("doc_id")
    bad = [r.text for r in docs.join(gone, "doc_id").limit(2).collect()]
    plain = docs.join(gone, "doc_id", "left_anti").where("length(text) > 300")
    clean = [r.text for r in plain.dropDuplicates(["text"]).orderBy("doc_id").limit(3).collect()]
    more = [(900_001, bad[0]), (900_001, clean[0] + " one"), (None, bad[1]), (None, clean[1] + " two"), (900_002, clean[2]), (900_002, clean[2] + " three"), (None, clean[2])]
    odd = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in more], docs.schema)
    kept = corpus_pipeline.without_toxic(spark, docs.unionByName(odd), sf_dir)
    assert sorted((r[1] for r in _extra(kept)), key=str) == sorted([clean[0] + " one", clean[1] + " two", clean[2], clean[2] + " three", clean[2]])
    kept = corpus_pipeline.without_copies(spark, kept, sf_dir)
    # the given document with the smaller id stays of the three equal ones
    assert sorted((r[1] for r in _extra(kept)), key=str) == sorted([clean[0] + " one", clean[1] + " two", clean[2] + " three"])


def _extra(df):
    return [r for r in map(tuple, df.collect()) if r[0] is None or r[0] > 900_000]


def test_odd_and_empty_tables(spark, sf_dir, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, sf_dir)
        assert 0 < found.count() <= odd.count()
        if name != "packing":
            assert tuple(found.columns) == corpus_pipeline.COLUMNS
        assert stage(spark, none, sf_dir).count() == 0


def test_run_ends_with_the_last_stage(spark, sf_dir, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, results["packing"][1].collect()))


def test_near_copies_go_by_their_own_text(spark, sf_dir, odd, none):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(3, one + " x"), (5, one), (5, two), (9, two + " y"), (None, one)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], none.select(*corpus_pipeline.COLUMNS).schema)
    kept = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == sorted([(3, one + " x"), (5, two), (0, one)])
    assert 0 < corpus_pipeline.without_near_copies(spark, odd, sf_dir).count() < odd.count()
    assert corpus_pipeline.without_near_copies(spark, none, sf_dir).count() == 0
