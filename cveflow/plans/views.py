"""The eight dashboard views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cveflow.functions import values as v
from cveflow.plans import kpis as reports
from cveflow.plans.kpis import on_partition
from cveflow.schema import RUN_DATE

__all__ = [
    "create_views", "critical_alerts", "daily_trends", "kpi_history", "latest_kpis", "monthly_trends",
    "on_partition", "register_views", "top_risks", "vendor_risk", "weaponization",
]

# Columns of the top-risk view.
TOP_RISK_COLUMNS = (
    "cve_id", "composite_risk_score", "risk_tier", "cvss_v31_base_score", "epss_score",
    "epss_percentile", "in_cisa_kev", "is_ransomware_related", "has_public_exploit",
    "exploit_count", "has_msf_module", "msf_module_count", "vendor_project", "product",
    "description_en", "published_ts", "days_since_published", "primary_cwe",
)


def _since(as_of: dt.date | str, days: int) -> Column:
    return F.lit(v.as_date(as_of) - dt.timedelta(days=days))


def _newest_run(df: DataFrame) -> DataFrame:
    """Rows of the newest partition; the subquery reads partition values only."""
    run = F.struct(*RUN_DATE)
    return df.where(run == df.agg(F.max(run)).scalar())


def latest_kpis(kpis: DataFrame) -> DataFrame:
    newest = kpis.agg(F.max("computed_date")).scalar()
    return kpis.where(F.col("computed_date") == newest).select(
        "kpi_name", "kpi_value", "kpi_type", "time_window", "computed_at", "computed_date"
    )


def kpi_history(kpis: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    return (
        kpis.where(F.col("computed_date") >= _since(as_of, 30))
        .select("kpi_name", "kpi_value", "kpi_type", "computed_date")
        .orderBy(F.col("computed_date").desc(), "kpi_name")
    )


def top_risks(risk: DataFrame, *, k: int = 100) -> DataFrame:
    return (
        _newest_run(risk)
        .where(F.col("composite_risk_score") > reports.HIGH_SCORE)
        .select(*TOP_RISK_COLUMNS)
        .orderBy(F.col("composite_risk_score").desc(), "cve_id")
        .limit(k)
    )


def _trend(trends: DataFrame, kind: str, since: Column, name: str) -> DataFrame:
    return (
        trends.where((F.col("trend_type") == kind) & (F.col("period").try_cast("date") >= since))
        .select(
            F.col("period").alias(name), "new_cves", "avg_cvss", "avg_epss", "cisa_kev_count",
            "exploitable_count",
        )
        .orderBy(F.col(name).desc())
    )


def daily_trends(trends: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    return _trend(trends, "daily", _since(as_of, 90), "date")


def monthly_trends(trends: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    return _trend(trends, "monthly", _since(as_of, 730), "month")


def weaponization(readiness: DataFrame) -> DataFrame:
    return _newest_run(readiness).groupBy("weaponization_level").agg(
        F.count("*").alias("cve_count"),
        v.mean(F.col("cvss_v31_base_score"), 2).alias("avg_cvss"),
        v.mean(F.col("epss_score"), 5).alias("avg_epss"),
        v.count_where(F.col("in_cisa_kev")).alias("in_kev"),
    ).orderBy(F.col("cve_count").desc(), "weaponization_level")


def critical_alerts(master: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    return reports.alerts(master, as_of=as_of)


def vendor_risk(master: DataFrame, *, k: int = 50) -> DataFrame:
    return reports.vendor_risk(master, k=k).drop("avg_epss")


def register_views(
    spark: SparkSession, tables: Mapping[str, DataFrame], *, as_of: dt.date | str
) -> list[str]:
    """Register the views over ``master``, ``risk``, ``trends``, ``readiness`` and ``kpis``."""
    frames = {
        "vw_latest_kpis": latest_kpis(tables["kpis"]),
        "vw_kpi_history": kpi_history(tables["kpis"], as_of=as_of),
        "vw_top_risks": top_risks(tables["risk"]),
        "vw_daily_trends": daily_trends(tables["trends"], as_of=as_of),
        "vw_monthly_trends": monthly_trends(tables["trends"], as_of=as_of),
        "vw_weaponization": weaponization(tables["readiness"]),
        "vw_critical_alerts": critical_alerts(tables["master"], as_of=as_of),
        "vw_vendor_risk": vendor_risk(tables["master"]),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


def create_views(spark: SparkSession, database: str, *, as_of: dt.date | str | None = None) -> list[str]:
    """Persistent views of the same names over the tables of ``database``; without ``as_of`` they follow the current date."""
    today = "current_date()" if as_of is None else f"DATE '{v.as_date(as_of)}'"
    exact = "CAST({} AS DECIMAL(30, 15))".format
    mean = f"CAST(round(avg({exact('cvss_v31_base_score')}), 2) AS DOUBLE) AS avg_cvss"
    newest = "WHERE struct(year, month, day) = (SELECT max(struct(year, month, day)) FROM {0})".format
    trend = "new_cves, avg_cvss, avg_epss, cisa_kev_count, exploitable_count"

    def t(name: str) -> str:
        return f"{database}.{name}"

    texts = {
        "vw_latest_kpis": f"""SELECT kpi_name, kpi_value, kpi_type, time_window, computed_at, computed_date FROM {t('kpis')}
            WHERE computed_date = (SELECT max(computed_date) FROM {t('kpis')})""",
        "vw_kpi_history": f"""SELECT kpi_name, kpi_value, kpi_type, computed_date FROM {t('kpis')}
            WHERE computed_date >= {today} - INTERVAL 30 DAYS ORDER BY computed_date DESC, kpi_name""",
        "vw_top_risks": f"""SELECT {', '.join(TOP_RISK_COLUMNS)} FROM {t('risk')} {newest(t('risk'))}
            AND composite_risk_score > {reports.HIGH_SCORE} ORDER BY composite_risk_score DESC, cve_id LIMIT 100""",
        "vw_daily_trends": f"""SELECT period AS date, {trend} FROM {t('trends')} WHERE trend_type = 'daily'
            AND try_cast(period AS DATE) >= {today} - INTERVAL 90 DAYS ORDER BY date DESC""",
        "vw_monthly_trends": f"""SELECT period AS month, {trend} FROM {t('trends')} WHERE trend_type = 'monthly'
            AND try_cast(period AS DATE) >= {today} - INTERVAL 730 DAYS ORDER BY month DESC""",
        "vw_weaponization": f"""SELECT weaponization_level, count(*) AS cve_count, {mean},
            CAST(round(avg({exact('epss_score')}), 5) AS DOUBLE) AS avg_epss, count_if(in_cisa_kev) AS in_kev
            FROM {t('readiness')} {newest(t('readiness'))} GROUP BY weaponization_level ORDER BY cve_count DESC, weaponization_level""",
        "vw_critical_alerts": f"""SELECT {', '.join(reports.ALERT_COLUMNS)} FROM {t('master')}
            WHERE to_date(published_ts) >= {today} - INTERVAL 7 DAYS
            AND (cvss_v31_base_score >= {reports.SEVERE_CVSS} OR in_cisa_kev OR epss_score > 0.7) ORDER BY cvss_v31_base_score DESC, cve_id""",
        "vw_vendor_risk": f"""SELECT vendor_project, count(cve_id) AS total_cves, {mean}, count_if(in_cisa_kev) AS kev_count,
            count_if(has_public_exploit) AS exploitable, count_if(has_msf_module) AS msf_modules,
            count_if(cvss_v31_severity = 'CRITICAL') AS critical_cves,
            round(count_if(has_public_exploit) / count(cve_id) * 100, 1) AS exploit_rate_pct
            FROM {t('master')} WHERE vendor_project IS NOT NULL AND vendor_project <> '' GROUP BY vendor_project
            HAVING count(cve_id) >= 5 AND count_if(has_public_exploit) >= 1 ORDER BY kev_count DESC, total_cves DESC, vendor_project LIMIT 50""",
    }
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {t(name)} AS {text}")
    return [t(name) for name in texts]
