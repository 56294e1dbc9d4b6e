"""Counts and averages of advisories by publication day, week, month and year."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from cveflow.functions import values as v

#: The columns all grains share.
COMMON = ("new_cves", "avg_cvss", "avg_epss", "cisa_kev_count", "exploitable_count")


def _published() -> Column:
    return F.to_date("published_ts")


def _period(grain: str) -> Column:
    return F.date_trunc(grain, _published()).cast("date")


def _severity(name: str) -> Column:
    return v.count_where(F.col("cvss_v31_severity") == name)


def _base() -> list[Column]:
    return [
        F.count("cve_id").alias("new_cves"),
        v.average(F.col("cvss_v31_base_score")).alias("avg_cvss"),
        v.average(F.col("epss_score")).alias("avg_epss"),
        v.count_where(F.col("in_cisa_kev")).alias("cisa_kev_count"),
        v.count_where(F.col("has_public_exploit")).alias("exploitable_count"),
    ]


def daily(master: DataFrame) -> DataFrame:
    return master.groupBy(_published().alias("publish_date")).agg(
        *_base(),
        v.count_where(F.col("has_msf_module")).alias("msf_count"),
        _severity("CRITICAL").alias("critical_count"),
        _severity("HIGH").alias("high_count"),
    ).orderBy("publish_date")


def weekly(master: DataFrame) -> DataFrame:
    """Weeks start on Monday."""
    return master.groupBy(_period("week").alias("week_start")).agg(
        *_base(), F.count_distinct("primary_cwe").alias("unique_cwes")
    ).orderBy("week_start")


def monthly(master: DataFrame) -> DataFrame:
    return master.groupBy(_period("month").alias("month_start")).agg(
        *_base(),
        v.count_where(F.col("has_msf_module")).alias("msf_count"),
        _severity("CRITICAL").alias("critical_count"),
        _severity("HIGH").alias("high_count"),
        _severity("MEDIUM").alias("medium_count"),
        _severity("LOW").alias("low_count"),
    ).orderBy("month_start")


def severity_by_year(master: DataFrame) -> DataFrame:
    return master.groupBy(F.year("published_ts").alias("pub_year"), "cvss_v31_severity").agg(
        F.count("cve_id").alias("cve_count")
    ).orderBy("pub_year", "cvss_v31_severity")


def cwe_by_year(master: DataFrame) -> DataFrame:
    return master.where(F.col("primary_cwe").isNotNull()).groupBy(
        F.year("published_ts").alias("pub_year"), "primary_cwe"
    ).agg(
        F.count("cve_id").alias("cve_count"), v.average(F.col("cvss_v31_base_score")).alias("avg_cvss")
    ).orderBy("pub_year", F.col("cve_count").desc(), "primary_cwe")


def combined(
    master: DataFrame, *, as_of: dt.date | str | None = None, now: dt.datetime | str | None = None
) -> DataFrame:
    """All three grains in one narrow frame, from one pass over the master.

    The master is reduced to one row of sums and counts per day; weeks and months are added up
    from those few rows.
    """
    per_day = master.groupBy(_published().alias("d")).agg(
        F.count("cve_id").alias("n"),
        F.sum(v.exact(F.col("cvss_v31_base_score"))).alias("cvss_sum"),
        F.count("cvss_v31_base_score").alias("cvss_n"),
        F.sum(v.exact(F.col("epss_score"))).alias("epss_sum"),
        F.count("epss_score").alias("epss_n"),
        v.count_where(F.col("in_cisa_kev")).alias("kev"),
        v.count_where(F.col("has_public_exploit")).alias("exploitable"),
    )
    grains = F.array(*[
        F.struct(F.lit(name).alias("trend_type"), start.alias("start"))
        for name, start in (
            ("daily", F.col("d")),
            ("weekly", F.date_trunc("week", "d").cast("date")),
            ("monthly", F.date_trunc("month", "d").cast("date")),
        )
    ])
    narrow = per_day.withColumn("g", F.explode(grains)).groupBy("g.trend_type", "g.start").agg(
        F.sum("n").alias("new_cves"),
        F.try_divide(F.sum("cvss_sum"), F.sum("cvss_n")).cast("double").alias("avg_cvss"),
        F.try_divide(F.sum("epss_sum"), F.sum("epss_n")).cast("double").alias("avg_epss"),
        F.sum("kev").alias("cisa_kev_count"),
        F.sum("exploitable").alias("exploitable_count"),
    )
    named = narrow.select("trend_type", F.col("start").cast("string").alias("period"), *COMMON)
    return v.stamped(named, as_of, now, "_computed_at")
