"""Trends that are kept up from run to run by what changed, instead of being counted anew.

The state is one row of exact sums and counts per publication day, and one count per week and weakness.  Both only add up, so the old
rows of changed advisories are taken out by a negative sign and the new ones put in.  All grains follow from the state;
they equal those of ``trends`` over the whole master.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from cveflow.functions import values as v
from cveflow.plans import trends

SUMS = ("cvss_sum", "epss_sum")
COUNTS = ("rows", "n", "cvss_n", "epss_n", "kev", "exploitable", "msf", "critical", "high", "medium", "low")


def _is(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("bigint")


def _values(sign: int) -> list[Column]:
    score, chance = F.col("cvss_v31_base_score"), F.col("epss_score")
    parts = {
        "cvss_sum": v.exact(score), "epss_sum": v.exact(chance), "rows": F.lit(1), "n": _is(F.col("cve_id").isNotNull()),
        "cvss_n": _is(score.isNotNull()), "epss_n": _is(chance.isNotNull()), "kev": _is(F.col("in_cisa_kev")),
        "exploitable": _is(F.col("has_public_exploit")), "msf": _is(F.col("has_msf_module")),
        **{name: _is(F.col("cvss_v31_severity") == name.upper()) for name in ("critical", "high", "medium", "low")}}
    return [(F.coalesce(c, v.exact(F.lit(0)) if k in SUMS else F.lit(0)) * sign).alias(k) for k, c in parts.items()]


def _days(master: DataFrame, sign: int) -> DataFrame:
    return master.select(F.to_date("published_ts").alias("d"), *_values(sign))


def _added(parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast("decimal(30,15)").alias(c) for c in SUMS]
    return parts.groupBy("d").agg(*sums, *[F.sum(c).alias(c) for c in COUNTS]).where("rows > 0")


def _weaknesses(master: DataFrame, sign: int) -> DataFrame:
    week = F.date_trunc("week", F.to_date("published_ts")).cast("date")
    return master.where("primary_cwe is not null").select(week.alias("week_start"), "primary_cwe", F.lit(sign).cast("bigint").alias("n"))


def state(master: DataFrame) -> DataFrame:
    """Sums and counts per day."""
    return _added(_days(master, 1))


def advance(days: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """The state after the advisories ``removed`` (their old rows) gave way to ``added`` (new rows, and advisories that are new)."""
    changes = _days(removed, -1).unionByName(_days(added, 1))
    return _added(days.select("d", *SUMS, *COUNTS).unionByName(changes))


def weaknesses(master: DataFrame) -> DataFrame:
    """Number of advisories per week and weakness."""
    return _weaknesses(master, 1).groupBy("week_start", "primary_cwe").agg(F.sum("n").alias("n"))


def advance_weaknesses(counts: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """``weaknesses`` after a change, like ``advance``."""
    parts = counts.unionByName(_weaknesses(removed, -1)).unionByName(_weaknesses(added, 1))
    return parts.groupBy("week_start", "primary_cwe").agg(F.sum("n").alias("n")).where("n > 0")


def replaced(master: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of ``master`` that ``changes`` replaces."""
    return master.join(changes.select("cve_id"), "cve_id", "left_semi")


def _narrow(total: Column, n: Column) -> Column:
    """As ``trends.combined`` divides."""
    return F.try_divide(total, n).cast("double")


def _wide(total: Column, n: Column) -> Column:
    """To as many places as ``avg`` keeps."""
    return F.try_divide(total.cast("decimal(30,15)"), n.cast("decimal(10,0)")).cast("decimal(34,19)").cast("double")


def _grain(days: DataFrame, period: Column, name: str, *more: str, mean=_wide) -> DataFrame:
    return days.groupBy(period.alias(name)).agg(
        F.sum("n").alias("new_cves"),
        mean(F.sum("cvss_sum"), F.sum("cvss_n")).alias("avg_cvss"),
        mean(F.sum("epss_sum"), F.sum("epss_n")).alias("avg_epss"),
        F.sum("kev").alias("cisa_kev_count"), F.sum("exploitable").alias("exploitable_count"),
        *[F.sum(c).alias(f"{c}_count") for c in more])


def _start(grain: str) -> Column:
    return F.date_trunc(grain, "d").cast("date")


def daily(days: DataFrame) -> DataFrame:
    return _grain(days, F.col("d"), "publish_date", "msf", "critical", "high").orderBy("publish_date")


def weekly(days: DataFrame, counts: DataFrame) -> DataFrame:
    distinct = counts.groupBy(F.col("week_start").alias("_week")).agg(F.count("*").alias("unique_cwes"))
    found = _grain(days, _start("week"), "week_start")
    joined = found.join(distinct, F.col("week_start").eqNullSafe(F.col("_week")), "left").drop("_week")
    return joined.fillna(0, ["unique_cwes"]).orderBy("week_start")


def monthly(days: DataFrame) -> DataFrame:
    return _grain(days, _start("month"), "month_start", "msf", "critical", "high", "medium", "low").orderBy("month_start")


def combined(days: DataFrame, *, as_of: dt.date | str | None = None, now: dt.datetime | str | None = None) -> DataFrame:
    """All three grains in one narrow frame, as ``trends.combined``."""
    grains = F.array(*[
        F.struct(F.lit(name).alias("trend_type"), start.alias("start"))
        for name, start in (("daily", F.col("d")), ("weekly", _start("week")), ("monthly", _start("month")))])
    flat = days.select("*", F.explode(grains).alias("g"))
    narrow = _grain(flat, F.struct("g.trend_type", "g.start"), "g", mean=_narrow).select(
        "g.trend_type", F.col("g.start").cast("string").alias("period"), *trends.COMMON)
    return v.stamped(narrow, as_of, now, "_computed_at")
