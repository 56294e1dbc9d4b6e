"""One query per operator over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cveflow.llm import (
    co_training, collision_search, exact_dedup, interval_search, language_crf, near_dups, packing, phrase_automata, piece_codec, pii,
    suffix_buckets, token_counts, toxicity)
from cveflow.llm.frames import held_out, texts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_codec.encode(_table(spark, sf_dir, "documents"), path, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    return collision_search.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of 0.85 or more."""
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"), 0.85)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch and place of every document, lengths in tokens of ``op1_piece_codec``."""
    return packing.pack_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by both views and together."""
    return co_training.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base kinds and all spans."""
    found = pii.find_pii(texts(_table(spark, sf_dir, "documents")))
    base = pii.of_kind(F.col("pii"), *pii.BASE)
    counts = [F.size(pii.of_kind(F.col("pii"), k)).cast("bigint").alias(f"n_{k}") for k in pii.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(F.col("pii")).alias("spans"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays for every document."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = _table(spark, sf_dir, "documents")
    found = language_crf.identify(docs, language_crf.train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 400 bytes that occur anywhere else, as digests."""
    return suffix_buckets.digests(suffix_buckets.cut_repeats(_table(spark, sf_dir, "documents")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return interval_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language whose words belong together most."""
    return phrase_automata.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_piece_codec, op2_quality, op3_pii, op4_collision_search, op5_near_dups, op6_packing, op7_token_counts, op8_toxicity, op9_exact_dedup, op10_language,
    op11_suffix_dedup, op12_ranked_search, op13_collocations)}

ORACLE = {
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY norm)""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        i AS (
            SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        q AS (SELECT item_id, text, term, count(*) AS times FROM i GROUP BY ALL),
        p AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
        s AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
        g AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM s),
        w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, nn),
        x AS (
            SELECT item_id, text, r, doc_id,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + ((75 * n * nn) // ll)))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN p USING (term) JOIN s USING (r), g GROUP BY item_id, text, r, doc_id),
        y AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM y WHERE rank <= 10""",
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
        t AS (SELECT lang, ws[i:i + 4] AS path FROM s),
        u AS (SELECT lang, path, unnest(range(1, len(path) + 1)) AS k FROM t),
        f AS (SELECT lang, path[1:k] AS ph, k::BIGINT AS k, count(*)::BIGINT AS f FROM u GROUP BY ALL HAVING count(*) >= 100),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        x AS (SELECT lang, ph[1:k - 1] AS ph, f FROM f WHERE k > 2 UNION ALL SELECT lang, ph[2:k] AS ph, f FROM f WHERE k > 2),
        o AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM x WHERE x.lang = f.lang AND x.ph = f.ph AND x.f >= f.f)),
        c AS (SELECT lang, ph, k, f, unnest(range(1, k)) AS cut FROM o),
        e AS (
            SELECT c.lang, c.ph, c.cut, c.f AS a, l.f AS l, r.f AS r, n.n,
                   ((1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM c JOIN f l ON l.lang = c.lang AND l.ph = c.ph[1:cut] JOIN f r ON r.lang = c.lang AND r.ph = c.ph[cut + 1:c.k]
            JOIN n ON n.lang = c.lang),
        b AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) AS best FROM e),
        z AS (
            SELECT *, array_to_string(ph, ' ') AS phrase,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank FROM b WHERE best = 1)
        SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000""",
}
