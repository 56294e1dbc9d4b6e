"""Scalar clean-up expressions.  Unparsable text becomes NULL, also with ANSI mode on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Ordinal of each module rank label.
RANKS = {"excellent": 7, "great": 6, "good": 5, "normal": 4, "average": 3, "low": 2, "manual": 1}


def number(c: Column) -> Column:
    return c.try_cast("double")


def day(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(c, fmt)


def clamp(c: Column, top: float) -> Column:
    """Into [0, top]; NULL stays NULL, NaN sorts above ``top`` and becomes that."""
    return F.when(c > top, top).when(c < 0.0, 0.0).otherwise(c)


def clamp01(c: Column) -> Column:
    return clamp(c, 1.0)


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def is_known(c: Column) -> Column:
    return F.coalesce(F.lower(c) == "known", F.lit(False))


def non_empty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def rank_number(c: Column) -> Column:
    """Ordinal of a rank label; a label that is itself an integer keeps its value."""
    labels = F.create_map(*[F.lit(v) for pair in RANKS.items() for v in pair])
    return F.coalesce(F.try_element_at(labels, F.lower(c)), c.try_cast("int"))


def text_list(c: Column) -> Column:
    return F.from_json(c, "array<string>")


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def as_time(value: dt.datetime | dt.date | str) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(value)


def timestamp(value: dt.datetime | dt.date | str) -> Column:
    """Literal in the session time zone, whatever the zone of the driver machine."""
    return F.lit(as_time(value).isoformat(sep=" ")).cast("timestamp")


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def exact(c: Column) -> Column:
    """A number as a decimal, whose sums don't depend on how the rows were partitioned."""
    return c.cast("decimal(30,15)")


def average(c: Column) -> Column:
    """Average from an exact sum."""
    return F.avg(exact(c)).cast("double")


def mean(c: Column, places: int) -> Column:
    """Average rounded half up, once."""
    return F.round(F.avg(exact(c)), places).cast("double")


def percent(part: Column, whole: Column, places: int) -> Column:
    return F.round(part / whole * 100, places)


def stamped(df, as_of: dt.date | str | None, now: dt.datetime | dt.date | str | None, name: str):
    """Run date and computing time of a mart; without ``as_of`` the frame is left as it is."""
    if as_of is None:
        return df
    return run_date(df, as_of).withColumn(name, timestamp(as_of if now is None else now))


def run_date(df, as_of: dt.date | str):
    """The partition columns ``year, month, day`` of a run."""
    d = as_date(as_of)
    return df.withColumns({
        "year": F.lit(d.year), "month": F.lit(d.month), "day": F.lit(d.day),
    })
