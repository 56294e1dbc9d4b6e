"""Exact dedup, personal data and packing."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from compare import difference
from cveflow.llm import exact_dedup, packing, pii, queries
from odd_tables import connect, make


def _normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def _groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(_normal(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[_normal(text)]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(_normal(text).encode()).hexdigest()))
    return sorted(out, key=str)


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_exact_groups_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert _found(exact_dedup.exact_groups(odd)) == _groups(rows)


def test_many_levels_and_colliding_digests(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab ", k=rng.randrange(60))) for _ in range(150)]
    texts += texts[:60] + ["ab" * 40, "ab" * 40 + "a", "ab" * 41]
    df = make(spark, texts)
    want = _groups(list(enumerate(texts)))
    assert _found(exact_dedup.exact_groups(df, block=3)) == want
    # a digest of two values makes nearly all blocks collide
    few = lambda c: F.crc32(c.cast("binary")) % 2
    assert _found(exact_dedup.exact_groups(df, block=3, digest=few)) == want


def test_exact_group_of_a_third_of_all_rows(spark):
    texts = ["copy of a page " * 30] * 400 + [f"page {i} " * 20 for i in range(800)]
    rows = exact_dedup.exact_groups(make(spark, texts), block=64).where("kept").collect()
    assert len(rows) == 801 and max(r.group_size for r in rows) == 400


def test_exact_query_equals_sql(spark, sf_dir):
    assert not difference(queries.op9_exact_dedup(spark, sf_dir), connect(sf_dir), queries.ORACLE["op9_exact_dedup"])


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4)
    return total % 10 == 0


def _base(text):
    spans = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                spans.append(f"{kind}:{m.start()}:{m.end()}")
    return spans


def test_base_spans_equal_plain_patterns(spark, odd):
    rng = random.Random(8)
    parts = ["a", "@", ".", "b.c", "1", "255", "256", " ", "-", "+", "(", "4111111111111111", "é", "😀", "0001", "_", "%", "10.0.0.1", "+12 345 678 90"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(1500)] + ["\n+1 (702) 555-0742\n", None, ""]
    df = make(spark, texts).select("doc_id", "text").unionByName(
        odd.where("doc_id is not null and length(text) < 100000").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    for r in pii.find_pii(df).collect():
        spans = [f"{s.kind}:{s.start}:{s.end}" for s in r.pii]
        assert [s for s in spans if s.split(":")[0] in BASE] == _base(r.text), r.text


def test_checked_and_contextual_spans(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00 end", "iban DE89 3704 0044 0532 0130 01 end", "phone: 702-555-0742 now", "code 702-555-0742 now"]
    rows = pii.find_pii(make(spark, texts)).orderBy("doc_id").collect()
    assert [[s.kind for s in r.pii] for r in rows] == [["iban"], [], ["local"], []]
    assert all(0 < s.score <= 1 for r in rows for s in r.pii)


def test_redaction(spark):
    texts = ["a@b.cd and 10.0.0.1.", "none", None, "é +1 (702) 555-0742 x"]
    df = pii.find_pii(make(spark, texts)).select("doc_id", pii.redacted(F.col("text"), F.col("pii")).alias("t"))
    assert [r.t for r in df.orderBy("doc_id").collect()] == ["[EMAIL] and [IP].", "none", None, "é [PHONE] x"]


def test_pii_is_native(odd):
    plan = pii.find_pii(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pii_of_odd_rows(odd, none):
    found = pii.find_pii(odd)
    assert found.count() == odd.count() and found.columns.count("pii") == 2
    assert pii.find_pii(none.drop("pii")).count() == 0


def _padding(histogram, chosen):
    return sum(n * (min(x for x in chosen if x >= length) - length) for length, n in histogram)


def test_limits_pad_least():
    rng = random.Random(3)
    for _ in range(300):
        histogram = [(x, rng.randrange(1, 9)) for x in rng.sample(range(40), rng.randrange(1, 9))]
        buckets, top = rng.randrange(1, 5), max(x for x, _ in histogram)
        lower = sorted(x for x, _ in histogram)[:-1]
        best = min(_padding(histogram, [*c, top]) for m in range(buckets) for c in itertools.combinations(lower, min(m, len(lower))))
        chosen = packing.limits(histogram, buckets)
        assert len(chosen) <= buckets and _padding(histogram, chosen) == best
    assert packing.limits([], 4) == []


def test_batches_hold_every_document_once(spark):
    rng = random.Random(6)
    sizes = [rng.randrange(0, 65) for _ in range(3000)] + [500, 500, None]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id bigint, n_tokens bigint")
    found = packing.pack(rows, buckets=4, longest=64, budget=256).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(sizes)))
    batches = {}
    for r in found:
        batches.setdefault(r.batch_id, []).append(r)
    for batch in batches.values():
        padded = {r.bucket_tokens for r in batch}
        assert len(padded) == 1 and sorted(r.slot for r in batch) == list(range(len(batch)))
        assert max(r.n_tokens for r in batch) <= padded.copy().pop()
        assert len(batch) == 1 or len(batch) * padded.pop() <= 256
    by_bucket = {}
    for batch in batches.values():
        by_bucket.setdefault(batch[0].bucket_tokens, []).append(len(batch))
    for limit, counts in by_bucket.items():
        full = 1 if limit > 64 else 256 // max(limit, 1)
        assert sum(c < full for c in counts) <= 1
    assert len({r.bucket_tokens for r in found}) == 5


def test_packing_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 10)
    rows = spark.createDataFrame([(i, 5) for i in range(203)], "doc_id bigint, n_tokens bigint")
    found = packing.pack(rows, budget=50).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in found) == [3] + [10] * 20


def test_packing_odd_and_empty(odd, none):
    found = packing.pack_documents(odd).collect()
    assert len(found) == odd.count() and all(r.n_tokens <= r.bucket_tokens for r in found)
    assert packing.pack_documents(none).count() == 0
    assert exact_dedup.exact_groups(none).count() == 0


def test_runs_of_digits_are_those_of_the_plain_pattern():
    rng = random.Random(31)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789  --.x") for _ in range(rng.randrange(80)))
        plain = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if len(re.sub("[^0-9]", "", m[0])) >= 13]
        assert [m.span() for m in re.finditer(pii.PATTERNS["card"][0], text)] == plain


@pytest.mark.parametrize("unit, kind, size", [
    ("12,", None, 0), ("a7@b.cd ", "email", 7), ("+1 234 555678;", "phone", 13), ("DE89370400440532013000;", "iban", 22), ("4111111111111111;", "card", 16)])
def test_texts_with_very_many_matches(spark, unit, kind, size):
    """A mebibyte of matches: all are found and replaced; a quadratic way would take hours."""
    times = (1 << 20) // len(unit)
    text = "é mail " + unit * times
    found = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    spans, cut = found.select(
        F.transform("pii", lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("pii"), pii.redacted(F.col("text"), F.col("pii")).alias("cut")).first()
    if kind is None:
        assert spans == [] and cut == text
    else:
        mine = [tuple(s) for s in spans if s[0] == kind]
        assert mine == [(kind, 7 + k * len(unit), 7 + k * len(unit) + size) for k in range(times)]
        assert cut.replace(f"[{kind.upper()}]", "") == "é mail " + unit[size:] * times or kind == "card"
