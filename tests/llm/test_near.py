"""Near duplicates, connected components and neighbour search against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cveflow.llm import collision_search, components, near_dups, queries, shingles
from odd_tables import make


def _sets(rows):
    out = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[doc_id] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    return out


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def _brute(rows, percent):
    sets = _sets(rows)
    ids = [i for i in sets if sets[i]]
    links = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    roots = _roots(sets, links)
    return sorted((i, len(sets[i]), roots[i], roots[i] == i) for i in sets)


def _copies(rng, n, words, edits):
    """Copies of one text with up to ``edits`` replaced words."""
    text = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(text)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    out = _copies(rng, 160, 150, 8) + _copies(rng, 60, 40, 2) + _copies(rng, 60, 90, 4)
    for size in range(1, 30):
        out += _copies(rng, 3, size, 1)
    out += ["Same Text here with More words", "same text HERE with more words", "ÄÖ a b c d", "äö a b c d"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, texts, percent):
    found = near_dups.near_duplicates(make(spark, texts), percent / 100)
    assert sorted(tuple(r) for r in found.collect()) == _brute(list(enumerate(texts)), percent)


def test_large_buckets_are_compared_in_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    found = near_dups.near_duplicates(make(spark, texts), 0.85)
    assert sorted(tuple(r) for r in found.collect()) == _brute(list(enumerate(texts)), 85)


def test_every_pair_survives_blocks_without_stars(spark, texts, monkeypatch):
    """With no links from pivots all pairs come from the blocks."""
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    verified, calls = near_dups._verified, []

    def first_gives_none(pairs, profiles, threshold):
        calls.append(1)
        return verified(pairs, profiles, threshold).where(F.lit(False))

    monkeypatch.setattr(near_dups, "_verified", first_gives_none)
    found = near_dups.near_duplicates(make(spark, texts), 0.85)
    assert sorted(tuple(r) for r in found.collect()) == _brute(list(enumerate(texts)), 85)
    assert len(calls) == 2


def _pages(p):
    """``p * p`` pages of one template with five fields of ``p`` values; any two pages agree in one field at most.

    A field breaks 5 of 195 shingles, so two pages have a similarity of 170 / 220 or 175 / 215, and all share what others have.
    """
    out = []
    for a in range(p):
        for b in range(p):
            page = [f"t{i}" for i in range(199)]
            for j in range(5):
                page[20 + 35 * j] = f"f{j}v{(a + j * b) % p}"
            out.append(" ".join(page))
    return out


def test_pages_of_one_template_give_no_pairs(spark, monkeypatch):
    """Pages just below the threshold, nearly all of whose pairs survive their signatures."""
    rows = _pages(13) + _copies(random.Random(4), 40, 120, 3)
    verified, blocks, sizes = near_dups._verified, near_dups._block_pairs, []

    def counted(pairs, profiles, threshold):
        sizes.append(pairs.count())
        return verified(pairs, profiles, threshold)

    def counted_blocks(members, n_bands, threshold, step):
        if step == "verify":
            sizes.append(members.count())
        return blocks(members, n_bands, threshold, step)

    monkeypatch.setattr(near_dups, "_verified", counted)
    monkeypatch.setattr(near_dups, "_block_pairs", counted_blocks)
    monkeypatch.setattr(near_dups, "BLOCK", 64)
    found = near_dups.near_duplicates(make(spark, rows), 0.85)
    assert sorted(tuple(r) for r in found.collect()) == _brute(list(enumerate(rows)), 85)
    stars, best, flagged = sizes
    # 14,196 pairs of pages; no step has more rows than members, which are in at most as many buckets as there are bands
    assert stars <= len(rows) and best <= len(rows) and 13 * 13 < flagged <= near_dups.bands(0.85) * len(rows)


def test_sets_travel_once_a_block_not_once_a_pair(spark, texts, monkeypatch):
    plans = []
    blocks = near_dups._block_pairs

    def planned(members, n_bands, threshold, step):
        out = blocks(members, n_bands, threshold, step)
        plans.append((step, members.columns, out._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(near_dups, "_block_pairs", planned)
    near_dups.near_duplicates(make(spark, texts), 0.85).count()
    assert [p[0] for p in plans] == ["best", "flag", "verify"]
    assert ["hashes" in p[1] for p in plans] == [False, False, True]
    # members are exploded over the blocks of their bucket, and sets come in by one join on the member
    assert plans[2][2].count("Generate") == 1


def test_repeated_ids_with_other_texts(spark):
    """Rows of one id with different texts are each linked by their own."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = [(5, one), (5, two), (3, near(one)), (9, near(two)), (5, three), (7, near(three)), (2, "alone with a few words"), (5, one), (None, one)]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "doc_id bigint, text string")
        found = near_dups.near_duplicates(table.withColumn("mark", F.substring("text", 1, 1)), 0.85, carry=("mark",)).collect()
        assert sorted((r.doc_id, r.mark, r.component_id, r.kept) for r in found if r.doc_id is not None) == sorted([
            (5, "a", 3, False), (5, "a", 3, False), (3, "a", 3, True), (5, "b", 5, True), (9, "b", 5, False), (5, "c", 5, True), (7, "c", 5, False),
            (2, "a", 2, True)])
        assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]


def test_near_duplicates_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    found = near_dups.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert sorted({tuple(r) for r in found if r.doc_id is not None}) == _brute(dict(rows).items(), 80)
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert near_dups.near_duplicates(none).count() == 0


def test_near_query(spark, sf_dir, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in queries.op5_near_dups(spark, sf_dir).collect()) == _brute(rows, 85)


def test_posterior_limits():
    for threshold in (0.8, 0.85):
        least = near_dups.least_matches(threshold)
        assert all(threshold * n * 0.6 < m < threshold * n for m, n in zip(least, range(64, 257, 64)))
        assert (1 - threshold**near_dups.ROWS) ** near_dups.bands(threshold) <= near_dups.MISS


def test_signatures_estimate_similarity():
    a, b = np.arange(900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    hashes = shingles.mix(np.concatenate((a, b)))
    minima = shingles.minima(hashes, np.array([0, 900, 1800]), 2000)
    assert abs((minima[0] == minima[1]).mean() - 0.8) < 0.04


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, rng.randrange(100, 160)) for _ in range(40)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    rng.shuffle(links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    found = components.components(spark.createDataFrame(links, "u bigint, v bigint"))
    assert {r.node: r.root for r in found.collect()} == _roots(nodes, [x for x in links if x[0] != x[1]])


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def _nearest(vectors, asks, k):
    out = {}
    for q in asks:
        near = sorted((float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out[q] = near[:k]
    return out


def test_recall_on_the_table(spark, sf_dir):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in table.collect()}
    found = {}
    for r in collision_search.nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = _nearest(vectors, [i for i in vectors if i % 20 == 0], 10)
    assert found.keys() == want.keys() and all(len(f) == 10 for f in found.values())
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert all(abs(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum()) - d) < 1e-9 for q, f in found.items() for d, i in f)


def test_blocks_give_the_same_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(500)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    one = collision_search.nearest(table, F.col("vec_id") % 10 == 0).collect()
    monkeypatch.setattr(collision_search, "BLOCK", 60)
    monkeypatch.setattr(collision_search, "QUERY_BLOCK", 7)
    many = collision_search.nearest(table, F.col("vec_id") % 10 == 0).collect()
    same = {tuple(r) for r in one} & {tuple(r) for r in many}
    assert len(one) == len(many) == 500 and len(same) >= 0.9 * len(one)


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 60)] + [(100, [1.0, 2.5]), (200, None), (201, []), (202, [0.0, 0.0]), (203, [1.0, None])]
    rows += [(204, [float("nan"), 1.0]), (205, [float("inf"), 1.0]), (None, [1.0, 2.0]), (300, [1.0, 2.0, 3.0]), (100, [1.0, 2.5])]
    table = spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<float>, rank int")
    found = {}
    for r in collision_search.nearest(table, F.col("vec_id") % 50 == 0, k=3).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    assert found == {0: [(1, 0.0), (2, 0.0), (3, 0.0)], 50: [(0, 0.0), (1, 0.0), (2, 0.0)], 100: [(0, 0.5), (1, 0.5), (2, 0.5)]}
    assert collision_search.nearest(table.limit(0), F.lit(True)).count() == 0
    assert len(collision_search.nearest(table.where("vec_id < 3"), F.lit(True)).collect()) == 6


def _least_distances(rows, asks, k):
    """Brute force: per query id and candidate id the least distance of any two of their vectors."""
    out = []
    for q in sorted({i for i, _ in rows if asks(i)}):
        near = {}
        for i, v in rows:
            if i != q:
                d = min(math.dist(v, w) for j, w in rows if j == q)
                near[i] = min(d, near.get(i, math.inf))
        out += [(q, n, i, d) for n, (d, i) in enumerate(sorted((d, i) for i, d in near.items())[:k], 1)]
    return out


def test_large_components_and_repeated_ids(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    rows += [(3, [0.5, 0.5, 0.1, 0.0]), (20, [9.0, 9.0, 9.0, 9.0]), (7, [-0.5, 0.2, 0.1, 0.0])]
    rows += [(41, [1e308, -1e308, 0.0, 0.0]), (42, [1e308, 1e308, 1.0, 1.0]), (50, [1e200, 0.0, 0.0, 0.0]), (60, [5e307, 1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for block in (20_000, 9):
        monkeypatch.setattr(collision_search, "BLOCK", block)
        got = sorted(map(tuple, collision_search.nearest(table, F.col("vec_id") % 10 == 0).collect()))
        want = _least_distances(rows, lambda i: i % 10 == 0, 10)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert all(g[3] == pytest.approx(w[3], rel=1e-12) for g, w in zip(got, want))


def test_vectors_are_not_copied_for_queries(spark, monkeypatch):
    monkeypatch.setattr(collision_search, "BLOCK", 10)
    monkeypatch.setattr(collision_search, "QUERY_BLOCK", 2)
    table = spark.range(200).select(F.col("id").alias("vec_id"), F.array(*[F.rand(n) for n in range(3)]).alias("embedding"))
    plan = collision_search.nearest(table, F.col("vec_id") % 10 == 0)._jdf.queryExecution().optimizedPlan().toString()
    # only the queries are exploded over the blocks
    assert plan.count("Generate") == 1 and "cogroup" not in plan.lower()
