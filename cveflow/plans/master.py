"""One wide row per advisory: NVD left-joined with the four other cleaned tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from cveflow.functions import values as v
from cveflow.operators.dedup import latest_by

# Columns that the master takes over.
NVD_COLUMNS = (
    "cve_id", "sourceIdentifier", "published_ts", "last_modified_ts", "vulnStatus",
    "description_en", "cvss_v31_base_score", "cvss_v31_severity", "cvss_v31_vector",
    "cvss_v31_attack_vector", "cvss_v31_attack_complexity", "primary_cwe",
)
KEV_COLUMNS = (
    "cve_id", "vendor_project", "product", "vulnerability_name", "date_added", "due_date",
    "is_ransomware_related", "required_action",
)
# What an advisory without a match in a joined table gets.
DEFAULTS = {
    "in_cisa_kev": False, "is_ransomware_related": False, "exploit_count": 0, "msf_module_count": 0,
    "epss_score": 0.0, "epss_percentile": 0.0, "cvss_v31_base_score": 0.0, "msf_max_rank": 0,
}


def exploit_links(exploits: DataFrame) -> DataFrame:
    """One row per (exploit, advisory it names); records without ids vanish."""
    return exploits.select(
        F.explode("cve_ids").alias("cve_id"),
        "exploit_id",
        F.col("description").alias("exploit_description"),
        "date_published_dt",
        F.col("author").alias("exploit_author"),
        "platform_clean",
        "exploit_type",
        "port_num",
    )


def module_links(modules: DataFrame) -> DataFrame:
    """One row per (module, advisory it names)."""
    return modules.select(
        F.explode("cve_ids").alias("cve_id"),
        "fullname",
        F.col("title").alias("msf_title"),
        "module_type",
        "rank_label",
        "rank_numeric",
        "disclosure_date_dt",
    )


def exploit_ids(exploits: DataFrame) -> DataFrame:
    """Distinct ``(cve_id, exploit_id)``: the ids of an advisory are rows, so none is too many."""
    return exploit_links(exploits).select("cve_id", "exploit_id").distinct()


def module_names(modules: DataFrame) -> DataFrame:
    """Distinct ``(cve_id, fullname)``."""
    return module_links(modules).select("cve_id", "fullname").distinct()


def exploit_rollup(exploits: DataFrame) -> DataFrame:
    """Per advisory: exploit count (an id repeated in one record counts each time), platforms,
    types and the earliest date.  ``exploit_ids`` has the ids."""
    return exploit_links(exploits).groupBy("cve_id").agg(
        F.count("exploit_id").alias("exploit_count"),
        F.sort_array(F.collect_set("platform_clean")).alias("exploit_platforms"),
        F.sort_array(F.collect_set("exploit_type")).alias("exploit_types"),
        F.min("date_published_dt").alias("earliest_exploit_date"),
    )


def module_rollup(modules: DataFrame) -> DataFrame:
    """Per advisory: module count, types and the best rank.  ``module_names`` has the names."""
    return module_links(modules).groupBy("cve_id").agg(
        F.count("fullname").alias("msf_module_count"),
        F.sort_array(F.collect_set("module_type")).alias("msf_module_types"),
        F.max("rank_numeric").alias("msf_max_rank"),
    )


def latest_epss(epss: DataFrame, *, tiebreak: list[str] | None = None) -> DataFrame:
    """Newest score of every advisory.

    Also takes rows that were typed but not yet reduced to one per day (``clean.epss_rows``): the
    newest day's newest ingestion wins either way, and one shuffle of the scores is saved.
    """
    newest = latest_by(epss, ["cve_id"], ["score_date", "_ingested_at"], tiebreak=tiebreak)
    return newest.select(
        "cve_id", "epss_score", "epss_percentile", F.col("score_date").alias("epss_score_date")
    )


def build(
    nvd: DataFrame,
    kev: DataFrame,
    epss: DataFrame,
    exploits: DataFrame,
    modules: DataFrame,
    *,
    as_of: dt.date | str,
    now: dt.datetime | str | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """The master table.  Every joined side has one row per ``cve_id``, so rows = NVD rows."""
    listed = kev.select(*KEV_COLUMNS, F.lit(True).alias("in_cisa_kev"))
    joined = (
        nvd.select(*NVD_COLUMNS)
        .join(listed, "cve_id", "left")
        .join(latest_epss(epss, tiebreak=tiebreak), "cve_id", "left")
        .join(exploit_rollup(exploits), "cve_id", "left")
        .join(module_rollup(modules), "cve_id", "left")
    )
    flagged = joined.fillna(DEFAULTS).withColumns({
        "has_public_exploit": F.col("exploit_count") > 0,
        "has_msf_module": F.col("msf_module_count") > 0,
        "days_since_published": age_days(F.col("published_ts"), as_of),
    })
    return v.stamped(flagged, as_of, now, "_gold_updated_at")


def age_days(published, as_of: dt.date | str):
    return F.datediff(F.lit(v.as_date(as_of)), F.to_date(published))
