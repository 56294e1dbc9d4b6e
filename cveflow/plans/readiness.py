"""Exploit availability, weaponization level and time from publication to first exploit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from cveflow.functions import values as v

# Upper bound in days of each time-to-exploit category.
T2E_BUCKETS = (("SAME_DAY", 0), ("WITHIN_7D", 7), ("WITHIN_30D", 30), ("WITHIN_90D", 90))
T2E_REST = "OVER_90D"


def days_to_exploit() -> Column:
    """Days from publication to the earliest exploit; NULL without one or if it came earlier."""
    days = F.datediff("earliest_exploit_date", F.to_date("published_ts"))
    return F.when(F.col("has_public_exploit") & (days >= 0), days)


def t2e_category(days: Column) -> Column:
    label = F.lit(T2E_REST)
    for name, most in reversed(T2E_BUCKETS):
        label = F.when(days <= most, name).otherwise(label)
    return F.when(days.isNotNull(), label)


def weaponization_level() -> Column:
    exploit, module = F.col("has_public_exploit"), F.col("has_msf_module")
    return (
        F.when(exploit & module, "FULL").when(module, "MODULE_ONLY").when(exploit, "EXPLOIT_ONLY")
        .otherwise("NONE")
    )


def build(
    master: DataFrame, *, as_of: dt.date | str | None = None, now: dt.datetime | str | None = None
) -> DataFrame:
    """Readiness table.  The timing is a conditional column, so no join is needed."""
    days = days_to_exploit()
    table = master.select(
        "cve_id", "description_en", "cvss_v31_severity", "cvss_v31_base_score", "epss_score",
        "primary_cwe", "published_ts", "earliest_exploit_date", "has_public_exploit",
        "exploit_count", "has_msf_module", "msf_module_count",
        weaponization_level().alias("weaponization_level"),
        "in_cisa_kev",
        days.alias("days_to_exploit"),
        t2e_category(days).alias("t2e_category"),
    )
    return v.stamped(table, as_of, now, "_computed_at")


def time_to_exploit(master: DataFrame) -> DataFrame:
    """Advisories with an exploit that appeared on or after the publication day."""
    return master.withColumn("time_to_exploit_days", days_to_exploit()).where(
        F.col("time_to_exploit_days").isNotNull()
    )


def tte_stats(master: DataFrame, *, exact: bool = False) -> DataFrame:
    """One row of statistics.  ``exact`` percentiles keep one counter per distinct day count."""
    days = F.col("time_to_exploit_days")

    def quantile(p: float) -> Column:
        if exact:
            return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY time_to_exploit_days)").cast("int")
        return F.percentile_approx(days, p)

    return time_to_exploit(master).agg(
        F.count("cve_id").alias("cves_with_exploit_timing"),
        v.average(days).alias("avg_days_to_exploit"),
        quantile(0.5).alias("median_days_to_exploit"),
        F.min(days).alias("min_days_to_exploit"),
        F.max(days).alias("max_days_to_exploit"),
        quantile(0.25).alias("p25_days"),
        quantile(0.75).alias("p75_days"),
        quantile(0.9).alias("p90_days"),
    )


def by_severity(master: DataFrame) -> DataFrame:
    grouped = master.groupBy("cvss_v31_severity").agg(
        F.count("cve_id").alias("total_cves"),
        v.count_where(F.col("has_public_exploit")).alias("with_exploit"),
        v.count_where(F.col("has_msf_module")).alias("with_msf"),
        v.count_where(F.col("in_cisa_kev")).alias("in_kev"),
        v.average(F.col("epss_score")).alias("avg_epss"),
    )
    return grouped.withColumns({
        "exploit_rate_pct": v.percent(F.col("with_exploit"), F.col("total_cves"), 2),
        "msf_rate_pct": v.percent(F.col("with_msf"), F.col("total_cves"), 2),
    }).orderBy("cvss_v31_severity")


def by_cwe(master: DataFrame, *, k: int = 20) -> DataFrame:
    """The ``k`` weaknesses with most advisories."""
    grouped = master.where(F.col("primary_cwe").isNotNull()).groupBy("primary_cwe").agg(
        F.count("cve_id").alias("total_cves"),
        v.count_where(F.col("has_public_exploit")).alias("with_exploit"),
        v.count_where(F.col("has_msf_module")).alias("with_msf"),
        v.average(F.col("cvss_v31_base_score")).alias("avg_cvss"),
        v.average(F.col("epss_score")).alias("avg_epss"),
    )
    return grouped.withColumn(
        "exploit_rate_pct", v.percent(F.col("with_exploit"), F.col("total_cves"), 2)
    ).orderBy(F.col("total_cves").desc(), "primary_cwe").limit(k)


def overview(master: DataFrame) -> DataFrame:
    """Five counts in one pass."""
    exploit, module = F.col("has_public_exploit"), F.col("has_msf_module")
    return master.agg(
        F.count("*").alias("total_cves"),
        v.count_where(exploit).alias("with_public_exploit"),
        v.count_where(module).alias("with_msf_module"),
        v.count_where(F.col("in_cisa_kev")).alias("in_cisa_kev"),
        v.count_where(exploit & module).alias("exploit_and_module"),
    )
