"""Keyed upsert of one table into another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from cveflow.operators.dedup import latest_by


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``df``; the job fails if one occurs twice.  Only the key columns are shuffled."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    message = F.concat(
        F.lit(f"duplicate source key ({', '.join(keys)}): "),
        F.to_json(F.struct(*[F.col(k) for k in keys])),
    )
    once = F.when(F.col("_n") > 1, F.raise_error(message).cast("bigint")).otherwise(F.col("_n")) == 1
    return counted.where(once).select(*keys)


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    *,
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` after a merge: source rows replace whole rows or are added, the rest stays.

    With ``order_cols`` the newest source row per key is used, otherwise a repeated source key
    fails the job.  ``target=None`` is the first load.  Write the result to a new path, never
    over the one being read.
    """
    if order_cols:
        source = latest_by(source, keys, order_cols)
        replaced = source.select(*keys)
    else:
        replaced = unique_keys(source, keys)
    if target is None:
        if order_cols:
            return source
        # the first load only checks the keys
        same = reduce(and_, [F.col(f"s.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])
        return source.alias("s").join(replaced.alias("k"), same, "left_semi")
    kept = target.join(replaced, list(keys), "left_anti")
    return source.unionByName(kept.select(*target.columns))
