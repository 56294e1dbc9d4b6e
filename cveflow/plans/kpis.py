"""KPI snapshot, its long form, and the report tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from cveflow.functions import values as v
from cveflow.schema import KPI_HISTORY

# Fixed values: (name, type, window) of the stored KPIs, in their order.
KPIS = (
    ("total_active_cves", "count", "all_time"),
    ("new_cves_today", "count", "daily"),
    ("new_cves_this_week", "count", "weekly"),
    ("new_cves_this_month", "count", "monthly"),
    ("new_cves_this_quarter", "count", "quarterly"),
    ("avg_cvss_scored", "score", "all_time"),
    ("avg_epss_scored", "score", "all_time"),
    ("high_epss_count", "count", "all_time"),
    ("critical_risk_count", "count", "all_time"),
    ("high_risk_count", "count", "all_time"),
    ("medium_risk_count", "count", "all_time"),
    ("low_risk_count", "count", "all_time"),
    ("exploitable_count", "count", "all_time"),
    ("exploitable_pct", "percentage", "all_time"),
    ("msf_module_count", "count", "all_time"),
    ("cisa_kev_count", "count", "all_time"),
    ("cisa_kev_pct", "percentage", "all_time"),
    ("ransomware_related_count", "count", "all_time"),
    ("unpatched_critical", "count", "all_time"),
    ("mom_change_pct", "percentage", "monthly"),
)
# Decimal places of the KPIs that are not counts.
PLACES = {
    "avg_cvss_scored": 2, "avg_epss_scored": 5, "exploitable_pct": 1, "cisa_kev_pct": 1,
    "mom_change_pct": 1,
}
# Limits used in several reports.
SEVERE_CVSS = 9.0
ALERT_EPSS = 0.7
HIGH_SCORE = 0.5
CLOSED_STATUS = ("Rejected", "Analyzed")
NO_CWE = ("NVD-CWE-noinfo", "NVD-CWE-Other", "")

# Columns of the alert report.
ALERT_COLUMNS = (
    "cve_id", "description_en", "cvss_v31_base_score", "cvss_v31_severity", "epss_score",
    "in_cisa_kev", "has_public_exploit", "has_msf_module", "is_ransomware_related",
    "published_ts", "vendor_project", "product",
)


def on_partition(df: DataFrame, date: dt.date | str) -> DataFrame:
    """Rows of one run; three equality filters on the partition columns prune the scan."""
    d = v.as_date(date)
    return df.where((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day))


def _published_since(day: dt.date) -> Column:
    return F.to_date("published_ts") >= F.lit(day)


def _months(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    this = v.as_date(as_of).replace(day=1)
    return this, (this - dt.timedelta(days=1)).replace(day=1)


def _month_counts(as_of: dt.date | str) -> list[Column]:
    this, last = _months(as_of)
    current = _published_since(this)
    previous = _published_since(last) & (F.to_date("published_ts") < F.lit(this))
    critical = F.col("cvss_v31_severity") == "CRITICAL"
    return [
        v.count_where(current).alias("this_month_cves"),
        v.count_where(previous).alias("last_month_cves"),
        v.count_where(current & critical).alias("this_month_critical"),
        v.count_where(previous & critical).alias("last_month_critical"),
    ]


def _change_pct() -> Column:
    before = F.col("last_month_cves")
    return (F.col("this_month_cves") - before) / F.greatest(before, F.lit(1)) * 100


def month_over_month(master: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    """This and the previous calendar month, one row."""
    return master.agg(*_month_counts(as_of)).withColumn("mom_change_pct", _change_pct())


def snapshot(master: DataFrame, risk: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    """All KPIs as one wide row: one aggregate over the master, one over the run's risk rows."""
    today = v.as_date(as_of)

    def since(days: int) -> Column:
        return v.count_where(_published_since(today - dt.timedelta(days=days)))

    def positive_mean(name: str) -> Column:
        return F.coalesce(v.average(F.when(F.col(name) > 0, F.col(name))), F.lit(0.0))

    totals = master.agg(
        F.count("*").alias("total_active_cves"),
        v.count_where(F.to_date("published_ts") == F.lit(today)).alias("new_cves_today"),
        since(7).alias("new_cves_this_week"),
        since(30).alias("new_cves_this_month"),
        since(90).alias("new_cves_this_quarter"),
        positive_mean("cvss_v31_base_score").alias("avg_cvss_scored"),
        positive_mean("epss_score").alias("avg_epss_scored"),
        v.count_where(F.col("epss_score") > 0.5).alias("high_epss_count"),
        v.count_where(F.col("has_public_exploit")).alias("exploitable_count"),
        v.count_where(F.col("has_msf_module")).alias("msf_module_count"),
        v.count_where(F.col("in_cisa_kev")).alias("cisa_kev_count"),
        v.count_where(F.col("is_ransomware_related")).alias("ransomware_related_count"),
        v.count_where(
            (F.col("cvss_v31_base_score") >= SEVERE_CVSS) & ~F.col("vulnStatus").isin(*CLOSED_STATUS)
        ).alias("unpatched_critical"),
        *_month_counts(as_of),
    )
    tiers = on_partition(risk, as_of).agg(*[
        v.count_where(F.col("risk_tier") == name).alias(f"{name.lower()}_risk_count")
        for name in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
    ])
    # Two one-row frames side by side: NULL-padded union, then the non-NULL value of each column.
    both = totals.unionByName(tiers, allowMissingColumns=True)
    wide = both.agg(*[F.max(c).alias(c) for c in both.columns])
    total = F.greatest(F.col("total_active_cves"), F.lit(1))
    return wide.withColumns({
        "exploitable_pct": F.col("exploitable_count") / total * 100,
        "cisa_kev_pct": F.col("cisa_kev_count") / total * 100,
        "mom_change_pct": _change_pct(),
    })


def to_long(
    snapshot: DataFrame, *, as_of: dt.date | str, now: dt.datetime | str | None = None
) -> DataFrame:
    """One row per KPI, stamped for the append-only history."""

    def value(name: str) -> Column:
        as_double = F.col(name).cast("double")
        if name not in PLACES:
            return as_double
        return F.round(as_double, PLACES[name])

    rows = F.array(*[
        F.struct(
            F.lit(name).alias("kpi_name"), value(name).alias("kpi_value"),
            F.lit(kind).alias("kpi_type"), F.lit(window).alias("time_window"),
        )
        for name, kind, window in KPIS
    ])
    long = snapshot.select(F.inline(rows)).withColumns({
        "computed_at": v.timestamp(now if now is not None else as_of),
        "computed_date": F.lit(v.as_date(as_of)),
    })
    return v.run_date(long, as_of).select(*KPI_HISTORY.names)


def weaponization(readiness: DataFrame) -> DataFrame:
    """Summary per level; the percentage is of all rows, also those without a level."""
    levels = readiness.groupBy("weaponization_level").agg(
        F.count("cve_id").alias("cve_count"),
        v.mean(F.col("cvss_v31_base_score"), 2).alias("avg_cvss"),
        v.mean(F.col("epss_score"), 5).alias("avg_epss"),
        v.count_where(F.col("in_cisa_kev")).alias("in_kev"),
        F.count("*").alias("_rows"),
    )
    # The window runs over one row per level, not over the readiness rows.
    everything = F.sum("_rows").over(Window.partitionBy())
    return (
        levels.withColumn("pct_of_total", v.percent(F.col("cve_count"), everything, 1))
        .where(F.col("weaponization_level").isNotNull())
        .drop("_rows")
        .orderBy(F.col("cve_count").desc(), "weaponization_level")
    )


def vendor_risk(master: DataFrame, *, k: int = 20) -> DataFrame:
    """The ``k`` vendors with most known-exploited advisories, of those with at least five
    advisories and one public exploit."""
    grouped = master.where(v.non_empty(F.col("vendor_project"))).groupBy("vendor_project").agg(
        F.count("cve_id").alias("total_cves"),
        v.mean(F.col("cvss_v31_base_score"), 2).alias("avg_cvss"),
        v.mean(F.col("epss_score"), 5).alias("avg_epss"),
        v.count_where(F.col("in_cisa_kev")).alias("kev_count"),
        v.count_where(F.col("has_public_exploit")).alias("exploitable"),
        v.count_where(F.col("has_msf_module")).alias("msf_modules"),
        v.count_where(F.col("cvss_v31_severity") == "CRITICAL").alias("critical_cves"),
    )
    return (
        grouped.where((F.col("total_cves") >= 5) & (F.col("exploitable") >= 1))
        .withColumn("exploit_rate_pct", v.percent(F.col("exploitable"), F.col("total_cves"), 1))
        .orderBy(F.col("kev_count").desc(), F.col("total_cves").desc(), "vendor_project")
        .limit(k)
    )


def cwe_summary(master: DataFrame, *, k: int = 15) -> DataFrame:
    """The ``k`` most frequent real weaknesses with at least ten advisories."""
    valid = F.col("primary_cwe").isNotNull() & ~F.col("primary_cwe").isin(*NO_CWE)
    grouped = master.where(valid).groupBy("primary_cwe").agg(
        F.count("cve_id").alias("cve_count"),
        v.mean(F.col("cvss_v31_base_score"), 2).alias("avg_cvss"),
        v.mean(F.col("epss_score"), 5).alias("avg_epss"),
        v.count_where(F.col("has_public_exploit")).alias("exploitable"),
        v.count_where(F.col("in_cisa_kev")).alias("in_kev"),
    )
    return (
        grouped.where(F.col("cve_count") >= 10)
        .withColumn("exploit_rate_pct", v.percent(F.col("exploitable"), F.col("cve_count"), 1))
        .orderBy(F.col("cve_count").desc(), "primary_cwe")
        .limit(k)
    )


def alerts(master: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    """Severe, known-exploited or likely-exploited advisories of the last seven days."""
    recent = _published_since(v.as_date(as_of) - dt.timedelta(days=7))
    severe = (
        (F.col("cvss_v31_base_score") >= SEVERE_CVSS)
        | F.col("in_cisa_kev")
        | (F.col("epss_score") > ALERT_EPSS)
    )
    return master.where(recent & severe).select(*ALERT_COLUMNS).orderBy(
        F.col("cvss_v31_base_score").desc(), F.col("epss_score").desc(), "cve_id"
    )


def top_risks(risk: DataFrame, *, k: int = 10) -> DataFrame:
    """The ``k`` highest scores above one half, ordered by the unrounded score."""
    return (
        risk.where(F.col("composite_risk_score") > HIGH_SCORE)
        .orderBy(F.col("composite_risk_score").desc(), "cve_id")
        .limit(k)
        .select(
            "priority_rank", "cve_id", F.round("composite_risk_score", 3).alias("risk_score"),
            "risk_tier", "cvss_v31_base_score", "epss_score", "in_cisa_kev", "has_public_exploit",
            "has_msf_module", "vendor_project", "product",
        )
    )
