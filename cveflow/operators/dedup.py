"""Newest-row selection and ranking by value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cveflow.scratch import stored


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order`` (NULLs last), then by ``tiebreak``.

    Without ``tiebreak`` a hash of the row decides, so the choice does not depend on row order.
    The ``row_number() = 1`` form lets the optimizer keep one row per key and input partition
    before the shuffle, so a key that holds a large share of the rows costs one row per task.
    """
    ranking = [F.col(c).desc_nulls_last() for c in order]
    if tiebreak is None:
        ranking.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).desc())
    else:
        ranking += [F.col(c).desc_nulls_last() for c in tiebreak]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def dense_ranks(df: DataFrame, col: str, out: str, *, most: int, desc: bool = True) -> DataFrame:
    """``(col, out)``: the dense rank of every distinct value, of which there are at most ``most``.

    Values are folded in every task before they meet, so ``most`` bounds what is sorted in one
    task; the job fails if the caller's bound doesn't hold.
    """
    order = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_first()
    rank = F.row_number().over(Window.orderBy(order))
    message = F.lit(f"more than {most} values of {col}")
    return df.groupBy(F.col(col)).agg(F.count("*").alias("_rows")).select(
        col, F.when(rank > most, F.raise_error(message).cast("int")).otherwise(rank).alias(out)
    )


def dense_rank_by_value(df: DataFrame, col: str, out: str, *, most: int, desc: bool = True) -> DataFrame:
    """``dense_rank() over (order by col)`` without moving the rows.

    The ranks of at most ``most`` values are broadcast to them.
    """
    ranks = dense_ranks(df, col, out, most=most, desc=desc).withColumnRenamed(col, "_value")
    return df.join(F.broadcast(ranks), F.col(col).eqNullSafe(F.col("_value")), "left").drop("_value")


def dense_rank_of_any(df: DataFrame, col: str, out: str, *, desc: bool = True) -> DataFrame:
    """``dense_rank() over (order by col)`` for any number of distinct values.

    The distinct values are sorted in ranges, each numbered on its own; the sizes of the ranges before are added.  Values that hold more
    than a thousandth of the rows, fewer than a thousand, are broadcast; rows of the others meet their rank in a shuffle.
    """
    order = F.col("_value").desc_nulls_last() if desc else F.col("_value").asc_nulls_first()
    values = df.groupBy(F.col(col).alias("_value")).agg(F.count("*").alias("_rows"))
    ranged = stored(values.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    # one row a range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"), F.sum("_rows").alias("_all"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), F.sum("_all").over(Window.partitionBy()).alias("_all"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    ranks = ranged.join(F.broadcast(offsets), "_range").select(
        "_value", (F.col("_offset") + place).cast("int").alias(out), (F.col("_rows") * 1000 > F.col("_all")).alias("_hot"))
    ranks = stored(ranks, "ranks")
    same = F.col(col).eqNullSafe(F.col("_value"))
    hot = df.join(F.broadcast(ranks.where("_hot")), same, "left")
    found = hot.where("_hot").drop("_value", "_hot")
    rest = hot.where("_hot is null").drop("_value", "_hot", out)
    return found.unionByName(rest.join(ranks.where("not _hot"), same).drop("_value", "_hot"))
