"""Raw feeds to typed, validated tables with one row per key.

``*_rows`` functions type and validate only; the functions named after the feed also keep the
newest row per key.  Dates, numbers and JSON that do not parse become NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cveflow.functions import ids, values as v
from cveflow.functions.values import clamp01, rank_number
from cveflow.operators.dedup import latest_by
from cveflow.schema import AUDIT, CLEAN

# Defaults of advisories without a CVSS v3.1 rating.
UNSCORED = {"cvss_v31_base_score": 0.0, "cvss_v31_severity": "UNKNOWN"}

# Where the cleaned fields sit inside the JSON columns.
FIRST_DESCRIPTION = "$[0].value"
FIRST_CWE = "$[0].description[0].value"
CVSS_METRICS = (
    "cvssMetricV31 array<struct<cvssData:struct<baseScore:string,baseSeverity:string,"
    "vectorString:string,attackVector:string,attackComplexity:string>>>"
)


# Key of each cleaned table, and what makes a row of a key the newest.
KEYS = {
    "nvd": ("cve_id",), "kev": ("cve_id",), "epss": ("cve_id", "score_date"),
    "exploits": ("exploit_id",), "modules": ("fullname",),
}
NEWEST = {
    "nvd": ("last_modified_ts", "_ingested_at"), "kev": ("_ingested_at",), "epss": ("_ingested_at",),
    "exploits": ("_ingested_at",), "modules": ("_ingested_at",),
}


def _newest(feed: str, rows: DataFrame, tiebreak: Sequence[str] | None) -> DataFrame:
    return latest_by(rows, KEYS[feed], NEWEST[feed], tiebreak=tiebreak)


def _select(df: DataFrame, feed: str) -> DataFrame:
    return df.select(*CLEAN[feed].names)


def nvd_rows(raw: DataFrame) -> DataFrame:
    """Typed and validated records; the five rating fields come from one parse of ``metrics``."""
    # The explicit mode keeps the five fields in one shared parse instead of five pruned ones.
    metrics = F.from_json("metrics", CVSS_METRICS, {"mode": "PERMISSIVE"})
    cvss = F.get(metrics["cvssMetricV31"], 0)["cvssData"]
    return (
        raw.withColumns({"cve_id": ids.normalise("id"), "_cvss": cvss})
        .where(ids.is_valid("cve_id"))
        .select(
            "cve_id",
            "sourceIdentifier",
            F.try_to_timestamp("published").alias("published_ts"),
            F.try_to_timestamp("lastModified").alias("last_modified_ts"),
            "vulnStatus",
            F.get_json_object("descriptions", FIRST_DESCRIPTION).alias("description_en"),
            v.number(F.col("_cvss.baseScore")).alias("cvss_v31_base_score"),
            F.col("_cvss.baseSeverity").alias("cvss_v31_severity"),
            F.col("_cvss.vectorString").alias("cvss_v31_vector"),
            F.col("_cvss.attackVector").alias("cvss_v31_attack_vector"),
            F.col("_cvss.attackComplexity").alias("cvss_v31_attack_complexity"),
            F.get_json_object("weaknesses", FIRST_CWE).alias("primary_cwe"),
            "references",
            *AUDIT,
        )
        .fillna(UNSCORED)
    )


def nvd(raw: DataFrame, *, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest revision of every advisory."""
    return _newest("nvd", nvd_rows(raw), tiebreak)


def kev_rows(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns({
        "cve_id": ids.normalise("cveID"),
        "vendor_project": F.trim("vendorProject"),
        "product": F.trim("product"),
        "vulnerability_name": F.trim("vulnerabilityName"),
        "date_added": v.day(F.col("dateAdded")),
        "short_description": F.trim("shortDescription"),
        "required_action": F.trim("requiredAction"),
        "due_date": v.day(F.col("dueDate")),
        "is_ransomware_related": v.is_known(F.col("knownRansomwareCampaignUse")),
        "date_released": v.day(F.substring("dateReleased", 1, 10)),
    })
    return _select(typed.where(ids.is_valid("cve_id")), "kev")


def kev(raw: DataFrame, *, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest known-exploited entry of every advisory."""
    return _newest("kev", kev_rows(raw), tiebreak)


def epss_rows(raw: DataFrame) -> DataFrame:
    # The clamp reads its input three times, so the text is parsed in a projection of its own.
    parsed = raw.withColumns({
        "cve_id": ids.normalise("cve"),
        "_score": v.number(F.col("epss")),
        "_percentile": v.number(F.col("percentile")),
    })
    valid = parsed.where(ids.is_valid("cve_id") & F.col("_score").isNotNull())
    typed = valid.withColumns({
        "epss_score": clamp01(F.col("_score")),
        "epss_percentile": clamp01(F.col("_percentile")),
        "score_date": v.day(F.col("date")),
    })
    return _select(typed, "epss")


def epss(raw: DataFrame, *, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest score of every advisory and day."""
    return _newest("epss", epss_rows(raw), tiebreak)


def exploit_rows(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns({
        "exploit_id": F.trim("id"),
        "date_published_dt": v.day(F.col("date_published")),
        "platform_clean": v.lower_trim(F.col("platform")),
        "exploit_type": v.lower_trim(F.col("type")),
        "port_num": F.col("port").try_cast("int"),
        "cve_ids": ids.extract_list("codes", ";"),
    }).withColumn("cve_count", F.size("cve_ids"))
    return _select(typed.where(v.non_empty(F.col("exploit_id"))), "exploits")


def exploits(raw: DataFrame, *, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest entry of every public exploit."""
    return _newest("exploits", exploit_rows(raw), tiebreak)


def module_rows(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns({
        "module_type": v.lower_trim(F.col("type")),
        "platforms": v.text_list(F.col("platform")),
        "rank_label": v.lower_trim(F.col("rank")),
        "rank_numeric": rank_number(F.col("rank")),
        "disclosure_date_dt": v.day(F.col("disclosure_date")),
        "mod_time_ts": F.try_to_timestamp(F.substring("mod_time", 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")),
        "authors": v.text_list(F.col("author")),
        "cve_ids": ids.keep_cves(v.text_list(F.col("references"))),
    }).withColumn("cve_count", F.size("cve_ids"))
    return _select(typed.where(v.non_empty(F.col("fullname"))), "modules")


def modules(raw: DataFrame, *, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest metadata of every exploit module."""
    return _newest("modules", module_rows(raw), tiebreak)


ROWS = {
    "nvd": nvd_rows, "kev": kev_rows, "epss": epss_rows, "exploits": exploit_rows,
    "modules": module_rows,
}


def update(
    feed: str, previous: DataFrame, raw: DataFrame, *, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """The cleaned table after more raw rows, without reading the raw history again.

    The newest of (newest so far, new rows) is the newest of all rows, so this equals a rebuild.
    """
    return _newest(feed, previous.select(*CLEAN[feed].names).unionByName(ROWS[feed](raw)), tiebreak)
