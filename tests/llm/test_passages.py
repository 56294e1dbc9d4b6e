"""Repeated passages, ranked search and collocations against brute force and DuckDB."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import difference
from cveflow.llm import interval_search, phrase_automata, queries, suffix_buckets
from odd_tables import connect, make


def _without_repeats(texts, span):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def _cut(df, **kwargs):
    return sorted((tuple(r) for r in suffix_buckets.without_repeats(df, **kwargs).collect()), key=repr)


@pytest.fixture(scope="module")
def passages():
    """Few letters, so that grams repeat; one passage in half of the texts, beside different neighbours."""
    rng = random.Random(5)
    common = "".join(rng.choice("abcd") for _ in range(90))
    short = common[:35]
    out = []
    for n in range(120):
        own = "".join(rng.choice("ab") for _ in range(rng.randrange(150)))
        out.append(own + rng.choice([common, short, "", common[rng.randrange(60) :]]) + "".join(rng.choice("cdä") for _ in range(rng.randrange(80))))
    return out + ["x" * 300, "xy" * 200, "ab" * 21, "", None, common, common, "a" * 39, "a" * 40, "b" * 41]


@pytest.mark.parametrize("crowd", [1024, 2])
def test_repeats_equal_brute_force(spark, passages, crowd):
    want = sorted(((i, *w) for i, w in enumerate(_without_repeats(passages, 40))), key=repr)
    assert sum(w[2] for w in want) > 1000
    assert _cut(make(spark, passages), span=40, gram=12, crowd=crowd) == want


def test_repeats_of_documents_equal_brute_force(spark, docs, sf_dir):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, _without_repeats([r.text for r in rows], 400))), key=repr)
    assert sum(w[2] for w in want) > 0
    assert sorted((tuple(r) for r in queries.op11_suffix_dedup(spark, sf_dir).collect()), key=repr) == want


def test_texts_and_spans_that_are_left_equal_brute_force(spark, passages):
    two = passages[-5]  # this and another passage, each beside other neighbours
    passages = [*passages, "e" + two[:45] + "fé" + "gh" * 30, "i" + "gh" * 30 + "è" + two[5:60] + "k", "m" + two[:60] + "n" + "gh" * 30]
    texts = [(t or "").encode() for t in passages]
    seen = Counter(t[i : i + 40] for t in texts for i in range(len(t) - 39))
    want = {}
    for i, t in enumerate(texts):
        gone = {k + j for k in range(len(t) - 39) if seen[t[k : k + 40]] > 1 for j in range(40)}
        starts, ends = (sorted(k + at for k in gone if k + step not in gone) for step, at in ((-1, 0), (1, 1)))
        want[i] = bytes(b for k, b in enumerate(t) if k not in gone), list(zip(starts, ends))
    cut = suffix_buckets.cut_repeats(make(spark, passages).repartition(3), span=40, gram=12)
    assert {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.spans]) for r in cut.collect()} == want
    assert sum(len(spans) > 1 for _, spans in want.values()) > 0 and any(b"\xa4" in kept for kept, _ in want.values())


def test_passages_of_many_words_go_by_their_bytes(spark):
    """57 words of 399 bytes hold no string of 400 bytes; with one byte more they go, and ``n_bytes`` is the length of the text either way."""
    rng = random.Random(10)
    own = ["".join(rng.choices("abcdefgh", k=900)) for _ in range(4)]
    passage = " ".join("".join(rng.choices("rstuvwxyz", k=6)) for _ in range(59))
    short, full = passage[:399], passage[:400]
    assert len(short.split()) > 50 and len(full) == 400
    texts = [f"{own[0]}1{short}2", f"{own[1]}3{short}4", own[2] + "5" + full[::-1] + "6", own[3] + "7" + full[::-1] + "8"]
    rows = {r.doc_id: r for r in suffix_buckets.cut_repeats(make(spark, texts)).collect()}
    assert [bytes(rows[i].kept).decode() for i in range(4)] == [*texts[:2], own[2] + "56", own[3] + "78"]
    assert [[tuple(s) for s in rows[i].spans] for i in range(4)] == [[], [], [(901, 1301)], [(901, 1301)]]
    assert [(r[1], r[2], r[3]) for r in _cut(make(spark, texts))] == [(1301, 0, 0), (1301, 0, 0), (1302, 400, 1), (1302, 400, 1)]


def test_long_texts_are_read_in_pieces(spark, passages, monkeypatch):
    monkeypatch.setattr(suffix_buckets, "PIECE", 64)
    for text in (passages[0], "xy" * 200, "x" * 300):
        data = np.frombuffer(text.encode(), np.uint8)
        batch = pa.RecordBatch.from_arrays([[text, text]], names=["text"])
        starts = []
        for row, offset, part, at in suffix_buckets._pieces(batch, 40):
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                assert bytes(part[a:b]) == bytes(data[offset : offset + b - a])
                starts += [(row, offset + k) for k in range(b - a - 39)]
        assert sorted(set(starts)) == [(r, k) for r in range(2) for k in range(len(data) - 39)] and len(set(starts)) == len(starts)


def test_buckets_are_refined_to_equal_strings():
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(40)] + ["a" * 50]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    for span in (3, 8, 13, 21):
        seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
        want = [i + span <= len(t) and seen[t[i : i + span]] > 1 for t in texts for i in range(len(t))]
        assert suffix_buckets.repeated(data, at, span).tolist() == want


def _held(step, batch):
    """MB of arrays that a step holds at most while it works on a batch, and its rows."""
    suffix_buckets._powers.clear()
    tracemalloc.start()
    rows = sum(out.num_rows for out in step(iter([batch])))
    held = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return held, rows


def test_workers_hold_a_piece_and_not_a_batch():
    rng = np.random.default_rng(8)
    texts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes().decode() for _ in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % i for i in range(2500)]), pa.array(texts)], names=["key", "text"])
    held, rows = _held(suffix_buckets._anchor_rows(400, 100), batch)
    assert rows > 2500 and held < 40
    wanted = pa.array([[{"low": k, "high": k + 300, "bucket": k, "region": i, "weight": 1} for k in (0, 500, 1000)] for i in range(2500)])
    bodies = suffix_buckets._bodies(400, 100)
    cut = pa.RecordBatch.from_arrays([batch.column(1), wanted], names=["text", "wanted"])
    held, rows = _held(bodies, cut)
    assert rows == 7500 and held < 40
    items = pa.Table.from_batches(list(bodies(iter([cut])))).combine_chunks().to_batches()[0]
    held, rows = _held(suffix_buckets._dealt(400), items)
    assert rows > 7500 and held < 40
    # buckets of three regions, then one bucket of as many regions as a task may get
    columns = items.select(["region", "weight", "body"]).columns
    for bucket, rows, limit in ((np.arange(7500) // 3, 7500, 40), (np.zeros(suffix_buckets.CROWD, np.int64), suffix_buckets.CROWD, 150)):
        part = pa.RecordBatch.from_arrays([pa.array(bucket), *(c.slice(0, rows) for c in columns)], names=["bucket", "region", "weight", "body"])
        assert _held(suffix_buckets._refined(400), part)[0] < limit


def test_repeats_in_a_text_longer_than_a_piece(spark):
    rng = random.Random(9)
    own = "".join(rng.choices("abcdefgh", k=suffix_buckets.PIECE + 5000))
    edge = own[suffix_buckets.PIECE - 700 : suffix_buckets.PIECE + 900]
    texts = [own, "x" + edge + own[:450], own[1000:1500] + "é" + own[-399:], own[3000:3399]]
    want = sorted(((i, *w) for i, w in enumerate(_without_repeats(texts, 400))), key=repr)
    assert [w[2] for w in want] == [1600 + 450 + 500, 1600 + 450, 500, 0]
    assert _cut(make(spark, texts)) == want


def test_repeats_of_odd_and_empty_tables(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, _without_repeats([r.text for r in rows], 400))), key=repr)
    assert _cut(odd) == want
    assert _cut(none) == []


def test_ranks_equal_sql(spark, sf_dir):
    assert difference(queries.op12_ranked_search(spark, sf_dir), connect(sf_dir), queries.ORACLE["op12_ranked_search"]) == ""


def _ranks(docs, items, k=10):
    """Straight from the definition: every document against every item."""
    found = [Counter(interval_search.terms((t or "").encode())) for _, t in docs]
    df = Counter(t for c in found for t in c)
    n_docs, n_terms = sum(1 for c in found if c), sum(sum(c.values()) for c in found)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), c in zip(docs, found):
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in interval_search.terms((text or "").encode()) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, n, s[3], -s[0]) for n, s in enumerate(heapq.nsmallest(k, scores), 1)]
    return sorted(out, key=repr)


def test_ranks_of_odd_tables_with_ties_and_repeats(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    texts = [(0, "the quick brown fox"), (0, "fox w3x3 1 The THE"), (1, None), (2, ""), (3, "..."), (None, "jumps é́ 日本語"), (4, "no id here"), (5, "q7 q8 q9")]
    items = spark.createDataFrame(texts + texts[:1], "item_id bigint, text string").withColumn("score", F.lit("clash"))
    for postings in (1 << 20, 3):
        got = sorted((tuple(r) for r in interval_search.ranked(odd.repartition(5), items, k=4, block=20, postings=postings).collect()), key=repr)
        assert got == _ranks(rows, texts, 4)
    assert interval_search.ranked(none, items).count() == 0
    assert interval_search.ranked(odd, items.limit(0)).count() == 0


def test_range_maximum_tables():
    rng = np.random.default_rng(4)
    counts = np.array([1, 7, 64, 3])
    docs = np.concatenate([np.sort(rng.choice(100, c, replace=False)) for c in counts])
    index = interval_search.Postings(np.arange(4), counts, docs, rng.integers(0, 9, len(docs)))
    for _ in range(300):
        t = int(rng.integers(4))
        a, b = index.lists[t]
        low = int(rng.integers(a, b))
        high = int(rng.integers(low + 1, b + 1))
        at = int(index.best(np.array([low]), np.array([high]))[0])
        assert low <= at < high and index.impact[at] == index.impact[low:high].max()


def test_collocations_equal_sql(spark, sf_dir):
    assert difference(queries.op13_collocations(spark, sf_dir), connect(sf_dir), queries.ORACLE["op13_collocations"]) == ""


def test_collocations_in_many_ranges_equal_sql(spark, docs, sf_dir):
    statement = queries.ORACLE["op13_collocations"].replace(">= 100", ">= 4").replace("<= 2000", "<= 300")
    found = phrase_automata.collocations(docs.repartition(6), at_least=4, first=300, shard=2000, size=1500)
    assert difference(found, connect(sf_dir), statement) == ""


def test_collocations_of_odd_and_empty_tables(spark, odd, none, tmp_path):
    odd.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.col("lang"))).select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    statement = queries.ORACLE["op13_collocations"].replace(">= 100", ">= 2")
    found = phrase_automata.collocations(spark.read.parquet(f"{tmp_path}/documents.parquet"), at_least=2, shard=500, size=400)
    assert found.count() > 0 and difference(found, con, statement) == ""
    assert phrase_automata.collocations(none).count() == 0


def test_automata_keep_paths_and_add_weights():
    rng = random.Random(7)
    words = sorted({bytes([97 + rng.randrange(5)]) * rng.randrange(1, 4) for _ in range(12)} | {b"\x00", b"z" * 300})
    automata, want = [], Counter()
    for _ in range(5):
        used = sorted(rng.sample(words, 8))
        rows = [[rng.randrange(1, 9) if k < n else 0 for k in range(5)] for n in (rng.randrange(1, 6) for _ in range(60))]
        weights = [rng.choice([1, 2, 70_000]) for _ in rows]
        for r, w in zip(rows, weights):
            want[tuple(used[k - 1] for k in r if k)] += w
        one = phrase_automata.Automaton.sorted(used, np.array(rows, np.int32), np.array(weights))
        automata.append(phrase_automata.Automaton.unpack(one.pack()))
    whole = phrase_automata.united(automata)
    paths = [tuple(whole.spelled(p)) for p in whole.paths.tolist()]
    assert dict(zip(paths, whole.weights.tolist())) == dict(want) and paths == sorted(paths)
    for path in [*paths, (b"a",), (b"zz", b"a"), (b"",)]:
        assert whole.place(path) == sum(p < path for p in paths)


def test_products_beyond_64_bits_are_exact(spark, monkeypatch):
    big = 3_037_000_500
    rows = [("en", 0, "", 10**13), ("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 3)]
    counted = spark.createDataFrame(rows, "lang string, words int, phrase string, f bigint")
    monkeypatch.setattr(phrase_automata, "counts", lambda *a: counted)
    found = phrase_automata.collocations(None).collect()
    assert [tuple(r) for r in found] == [("en", 1, "a b", big - 3, big, big + 7, 10**13, 1000 * (big - 3) * 10**13 // (big * (big + 7)))]
