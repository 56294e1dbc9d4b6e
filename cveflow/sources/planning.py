"""What to request next from a paged, time-windowed feed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cveflow.functions import values as v

# Limits of the feed, and the start of a full load.
WINDOW_DAYS = 119
PAGE_ROWS = 2000
FULL_LOAD_SINCE = "1999-01-01"


def high_water_mark(
    raw: DataFrame, col: str = "lastModified", *, exclude_sources: Sequence[str] = ("synthetic",)
) -> DataFrame:
    """One row: the newest value from a real source, the full-load start if there is none.

    Supplementary rows are left out: their dates may lie in the future, and a mark in the future
    would plan no window at all.
    """
    own = F.coalesce(~F.col("_source").isin(*exclude_sources), F.lit(True)) if exclude_sources else F.lit(True)
    return raw.where(own).agg(
        F.coalesce(F.max(col), F.lit(FULL_LOAD_SINCE)).alias("high_water_mark")
    )


def plan_windows(
    spark: SparkSession,
    since: dt.datetime | dt.date | str,
    until: dt.datetime | dt.date | str,
    *,
    days: int = WINDOW_DAYS,
) -> DataFrame:
    """Consecutive ``(window_start, window_end)`` of at most ``days`` days covering the span."""
    start, end = v.timestamp(since), v.timestamp(until)
    if v.as_time(since) >= v.as_time(until):
        return spark.range(0).select(start.alias("window_start"), end.alias("window_end"))
    step = F.make_dt_interval(F.lit(days))
    starts = spark.range(1).select(F.explode(F.sequence(start, end, step)).alias("window_start"))
    return starts.where(F.col("window_start") < end).select(
        "window_start", F.least(F.col("window_start") + step, end).alias("window_end")
    )


def window_start(
    modified: Column, since: dt.datetime | dt.date | str, *, days: int = WINDOW_DAYS
) -> Column:
    """The window of ``plan_windows`` a time falls in, by arithmetic: no range join is needed."""
    start = v.timestamp(since)
    seconds = F.unix_timestamp(modified) - F.unix_timestamp(start)
    number = F.floor(seconds / (days * 86400))
    return start + F.make_dt_interval((number * days).cast("int"))


def count_by_window(
    raw: DataFrame,
    since: dt.datetime | dt.date | str,
    until: dt.datetime | dt.date | str,
    *,
    col: str = "lastModified",
    days: int = WINDOW_DAYS,
) -> DataFrame:
    """``(window_start, total)`` of the rows modified in the span, its end included."""
    modified = F.try_to_timestamp(col)
    last = v.as_time(until)
    inside = raw.where((modified >= v.timestamp(since)) & (modified <= v.timestamp(last)))
    # A time equal to ``until`` belongs to the last window, not to an empty one after it.
    before = F.least(modified, v.timestamp(last - dt.timedelta(seconds=1)))
    return inside.groupBy(window_start(before, since, days=days).alias("window_start")).agg(
        F.count("*").alias("total")
    )


def plan_offsets(windows: DataFrame, *, page: int = PAGE_ROWS) -> DataFrame:
    """One row per page of every window; windows without rows need no request."""
    pages = F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(page).cast("long"))
    return windows.where(F.col("total") > 0).withColumn("offset", F.explode(pages))
