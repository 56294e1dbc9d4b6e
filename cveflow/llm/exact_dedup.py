"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of ``BLOCK`` characters.  The distinct blocks of the corpus are sorted,
and the place of a block in that order becomes its integer name; then the distinct pairs of adjacent
names are sorted and named in the same way, round after round, until one name is left of each
document.  Two documents end with the same name in the same round exactly if their texts are equal.

The order of the blocks is (digest, content): contents are only compared where two different blocks
share a digest, so names never collide, while occurrences travel as digests.  The content itself is
shuffled once, after each task has folded its own repeats.  The order is dealt over ``SHARDS`` shards,
each numbering its own part, so no task sorts the whole corpus.

Nulls: a null text counts as empty; a null id never wins against another id.  Rows that share both id
and text are all marked as kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cveflow.llm.frames import SPACE, attach, texts
from cveflow.scratch import stored

BLOCK = 8192
SHARDS = 1 << 12
#: The names of a shard are numbered from shard * SPAN on.
SPAN = 1 << 44


def normalized(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def blocks(text: Column, block: int = BLOCK) -> Column:
    """Pieces of ``block`` characters, the last one shorter; an empty text is one empty piece."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(pieces)


def _ranked(keys: DataFrame, by: list[str], width: Column) -> DataFrame:
    """``keys`` with ``name``: the integers from there on, ``width`` of them, belong to the key."""
    before = Window.partitionBy("shard").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sharded = keys.withColumn("shard", F.pmod(F.xxhash64(*by), F.lit(SHARDS)))
    place = F.coalesce(F.sum(width).over(before), F.lit(0))
    return sharded.withColumn("name", F.col("shard") * SPAN + place).drop("shard")


def _block_names(pieces: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """First name per digest; and, if any digest stands for several blocks, the place of each of those."""
    distinct = pieces.groupBy("digest", "piece").agg(F.count("*").alias("n"))
    digests = stored(
        distinct.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("variants")), "digests")
    names = stored(_ranked(digests, ["digest"], F.col("variants")).select("digest", "n", "name"), "names")
    shared = digests.where("variants > 1").select("digest")
    if shared.isEmpty():
        return names, None
    place = F.row_number().over(Window.partitionBy("digest").orderBy("piece")) - 1
    return names, stored(distinct.join(shared, "digest").select("digest", "piece", place.alias("place")), "places")


def _occurrences(text: DataFrame, places: DataFrame | None, block: int, digest) -> DataFrame:
    """One row per block of each document, the ``i``-th of ``m``."""
    rows = text.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
        blocks(F.col("text"), block).alias("pieces"))
    own = ["row", "doc_id", "text_sha256", F.size("pieces").alias("m")]
    if places is None:
        digests = F.transform("pieces", lambda p: digest(p))
        flat = rows.select(*own, F.posexplode(digests).alias("i", "digest")).withColumn("place", F.lit(0))
    else:
        flat = rows.select(*own, F.posexplode("pieces").alias("i", "piece")).withColumn("digest", digest(F.col("piece")))
        flat = flat.join(places, ["digest", "piece"], "left").withColumn("place", F.coalesce("place", F.lit(0)))
    return stored(flat.select("row", "doc_id", "text_sha256", "m", "i", "digest", "place"), "blocks")


def _halved(current: DataFrame) -> DataFrame:
    """Adjacent names of a document as pairs; the last of an odd number stands alone, as (name, -1)."""
    even = F.col("i") % 2 == 0
    return current.groupBy("row", ((F.col("m") + 1) / 2).cast("int").alias("m"), (F.col("i") / 2).cast("int").alias("i")).agg(
        F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))


def identities(docs: DataFrame, block: int = BLOCK, digest=F.xxhash64) -> DataFrame:
    """``row`` (its number), ``doc_id``, ``text_sha256`` and the identity ``level, name`` of every document.

    ``digest`` maps a block to a long; any function gives the same groups.
    """
    text = texts(docs).select("doc_id", normalized(F.col("text")).alias("text"))
    pieces = text.select(F.explode(blocks(F.col("text"), block)).alias("piece"))
    names, places = _block_names(pieces.select(digest(F.col("piece")).alias("digest"), "piece"))
    flat = _occurrences(text, places, block, digest)
    total, longest = flat.agg(F.count("*"), F.max("m")).first()
    current = attach(flat, names, ["digest"], total).select("row", "m", "i", (F.col("name") + F.col("place")).alias("name"))
    if (longest or 0) > 1:
        current = stored(current, "names-0")
    done = [current.where("m = 1").select("row", F.lit(0).alias("level"), "name")]
    for level in range(1, ((longest or 1) - 1).bit_length() + 1):
        pairs = stored(_halved(current.where("m > 1")), f"pairs-{level}")
        counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
        named = stored(_ranked(counted, ["a", "b"], F.lit(1)).select("a", "b", "n", "name"), f"ranks-{level}")
        current = stored(attach(pairs, named, ["a", "b"], pairs.count()).select("row", "m", "i", "name"), f"names-{level}")
        done.append(current.where("m = 1").select("row", F.lit(level).alias("level"), "name"))
    ids = flat.where("i = 0").select("row", "doc_id", "text_sha256")
    return ids.join(reduce(DataFrame.unionByName, done), "row")


def exact_groups(docs: DataFrame, block: int = BLOCK, digest=F.xxhash64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every document; of equal texts the smallest id is kept."""
    found = stored(identities(docs, block, digest), "identities")
    groups = found.groupBy("level", "name").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id"))
    groups = stored(groups.withColumn("group_size", F.col("n")), "groups")
    return attach(found, groups, ["level", "name"], found.count()).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
