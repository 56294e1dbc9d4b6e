"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed value: the white space that separates words and that exact dedup folds.
SPACE = r"[\x20\x09-\x0D]"

#: A key with more than 1/HOT_SHARE of the rows is hot; so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, null text as empty; other columns, whatever their names, are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def attach(rows: DataFrame, named: DataFrame, keys: Sequence[str], total: int) -> DataFrame:
    """Inner join of ``rows`` with ``named`` (one row per key, ``n`` = its rows in ``rows``) that hot keys don't skew.

    Keys of more than ``total / HOT_SHARE`` rows are fewer than HOT_SHARE, so the driver may hold their hashes;
    their names are broadcast.  Rows of all other keys are shuffled, where no key can hold more than that share.
    Keys are never null.
    """
    keys, mark = list(keys), F.xxhash64(*keys)
    hot = [r.mark for r in named.where(F.col("n") > total // HOT_SHARE).select(mark.alias("mark")).distinct().collect()]
    named = named.drop("n")
    if not hot:
        return rows.join(named, keys)
    common = rows.where(mark.isin(hot)).join(F.broadcast(named.where(mark.isin(hot))), keys)
    return common.unionByName(rows.where(~mark.isin(hot)).join(named.where(~mark.isin(hot)), keys))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of the documents whose labels no model may see; a null id counts as seen."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
