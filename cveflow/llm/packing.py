"""Length buckets with the least padding, and batches of a token budget inside them.

The histogram of all lengths up to ``longest`` goes to the driver (at most ``longest + 1`` rows), where
dynamic programming chooses the bucket limits with the least total padding.  Every document is
padded to the limit of its bucket; a batch holds as many documents as the budget allows.  Documents
over ``longest`` are batches of their own, unpadded.  The places in a bucket are numbered by shards of a
hash of the id, so no task sees a whole bucket; every batch but the last of a bucket is full.

``pack_tokens`` takes exact token counts, the end token included; ``pack_documents`` takes words.

Nulls: a null text has no words and one token, the end; a null length counts as 0; rows with a null id are packed like others.  Repeated rows are
packed each for itself.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cveflow.llm import piece_codec
from cveflow.scratch import stored

BUCKETS = 16
BUDGET = 32768
#: Two longer documents never fit into one batch; alone and unpadded they pad least.
LONGEST = BUDGET // 2
#: Rows that one shard of a bucket holds, about.
SHARD_ROWS = 50_000
#: Batches of bucket i are numbered from i * SPAN on.
SPAN = 1 << 44


def words(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def limits(histogram: Sequence[tuple[int, int]], buckets: int) -> list[int]:
    """Upper limits of at most ``buckets`` buckets that pad the lengths of ``(length, count)`` least.

    With k buckets the best padding up to the j-th length is the least, over the last limit i before it, of
    best(k - 1, i) + length_j * (documents from i to j) - (tokens from i to j): for each k the
    lower envelope of lines in length_j, whose slopes fall with i, so each k takes linear time.
    """
    lengths = sorted(histogram)
    count, tokens = [0], [0]
    for length, n in lengths:
        count.append(count[-1] + n)
        tokens.append(tokens[-1] + n * length)
    best = [0] + [None] * len(lengths)
    cuts = []
    for _ in range(min(buckets, len(lengths))):
        lines: list[tuple[int, int, int]] = []
        after, cut, at = [None] * (len(lengths) + 1), [0] * (len(lengths) + 1), 0
        for j in range(1, len(lengths) + 1):
            if best[j - 1] is not None:
                line = (-count[j - 1], best[j - 1] + tokens[j - 1], j - 1)
                while len(lines) > 1 and _above(lines[-2], lines[-1], line):
                    lines.pop()
                lines.append(line)
            if lines:
                x, at = lengths[j - 1][0], min(at, len(lines) - 1)
                while at + 1 < len(lines) and lines[at + 1][0] * x + lines[at + 1][1] <= lines[at][0] * x + lines[at][1]:
                    at += 1
                after[j] = lines[at][0] * x + lines[at][1] + x * count[j] - tokens[j]
                cut[j] = lines[at][2]
        after[0] = 0
        best, _ = after, cuts.append(cut)
    chosen, j = [], len(lengths)
    for cut in reversed(cuts):
        if j:
            chosen.append(lengths[j - 1][0])
            j = cut[j]
    return sorted(chosen)


def _above(a: tuple[int, int, int], b: tuple[int, int, int], c: tuple[int, int, int]) -> bool:
    """Whether line ``b`` is nowhere below both ``a`` and ``c``; slopes fall from ``a`` to ``c``."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(lengths: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, budget: int = BUDGET) -> DataFrame:
    """Batches for rows of ``doc_id, n_tokens``: adds ``bucket_tokens`` (padded length), ``batch_id`` and ``slot``."""
    rows = lengths.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"))
    counted = rows.groupBy(F.least("n_tokens", F.lit(longest + 1)).alias("n_tokens")).count().collect()
    chosen = limits([(r.n_tokens, r["count"]) for r in counted if r.n_tokens <= longest], buckets)
    shards = 1 + sum(r["count"] for r in counted) // SHARD_ROWS
    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= limit, i) for i, limit in enumerate(chosen)], F.lit(len(chosen)))
    placed = rows.withColumn("bucket", bucket).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    size = placed.groupBy("bucket", "shard").count()
    earlier = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = size.select("bucket", "shard", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    order = Window.partitionBy("bucket", "shard").orderBy("doc_id", "n_tokens")
    numbered = placed.join(start.hint("merge"), ["bucket", "shard"]).withColumn("place", F.col("start") + F.row_number().over(order) - 1)
    limit = F.coalesce(F.get(F.array(*map(F.lit, [*chosen, None])).cast("array<bigint>"), F.col("bucket")), F.col("n_tokens"))
    holds = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_tokens", F.lit(1))))
    holds = F.when(F.col("bucket") == len(chosen), F.lit(1)).otherwise(holds)
    return numbered.withColumn("bucket_tokens", limit).withColumn("holds", holds.cast("bigint")).select(
        "doc_id", "n_tokens", "bucket_tokens",
        (F.col("bucket") * F.lit(SPAN) + F.floor(F.col("place") / F.col("holds"))).cast("bigint").alias("batch_id"),
        (F.col("place") % F.col("holds")).cast("int").alias("slot"))


def pack_tokens(docs: DataFrame, model_path: str, buckets: int = BUCKETS, longest: int = LONGEST, budget: int = BUDGET) -> DataFrame:
    """``pack`` for documents by their tokens in the SentencePiece model at ``model_path``, counted once."""
    return pack(stored(piece_codec.counts(docs, model_path), "lengths"), buckets, longest, budget)


def pack_documents(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, budget: int = BUDGET) -> DataFrame:
    """``pack`` for documents by words: all limits are words here, which hold several tokens each, any number where a text has no spaces."""
    return pack(docs.select("doc_id", words(F.col("text")).alias("n_tokens")), buckets, longest, budget)
