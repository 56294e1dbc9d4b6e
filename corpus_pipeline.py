"""Documents to training batches: the stages in order, each a function of (spark, documents, table folder).

Every stage reads all that the one before it kept.  All but the last return the columns of ``documents``.
Extra columns are dropped.  An empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cveflow.llm import exact_dedup, near_dups, packing, pii
from cveflow.llm import toxicity as toxic
from cveflow.scratch import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, doesn't call toxic; each row by its own text, whatever its id."""
    model = toxic.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic.score(docs, model, COLUMNS).where(F.col("score") < toxic.THRESHOLD).select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space, the document with the smallest id; without any id in the group, all rows.

    A row goes by its id and its text, so another text under the same id stays, and a copy without an id goes.
    """
    gone = exact_dedup.exact_groups(docs).where(~F.col("kept")).select(F.col("doc_id").alias("id"), "text_sha256").distinct()
    own = F.sha2(exact_dedup.normalized(F.coalesce("text", F.lit(""))), 256)
    keyed = docs.select(*COLUMNS, own.alias("own"))
    return keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["id"]) & (keyed["own"] == gone["text_sha256"]), "left_anti").select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingles, the one with the smallest id.

    A row goes by its id and its text, so another text under the same id stays; rows without an id are linked with nothing and stay.
    """
    own = F.sha2(F.coalesce("text", F.lit("")), 256).alias("own")
    keyed = docs.select(*COLUMNS, own)
    gone = near_dups.near_duplicates(keyed, carry=("own",)).where(~F.col("kept")).select("doc_id", "own").distinct()
    return keyed.join(gone, ["doc_id", "own"], "left_anti").select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind; ``n_chars`` follows the text where it changed."""
    found = pii.find_pii(docs.select(*COLUMNS))
    changed = F.size("pii") > 0
    cleaned = found.withColumn("text", pii.redacted(F.col("text"), F.col("pii")))
    return cleaned.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batch and place of every document, lengths in tokens."""
    return packing.pack_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", without_toxic), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
    ("pii", without_personal_data), ("packing", packed),
]

#: A classifier and a sketch with chance misses have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
