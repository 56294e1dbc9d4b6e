"""Declared schemas of the raw tables, the cleaned tables and the marts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# Source columns of the five raw feeds, all nullable strings.
NVD_FIELDS = (
    "id", "sourceIdentifier", "published", "lastModified", "vulnStatus", "cveTags",
    "descriptions", "metrics", "weaknesses", "configurations", "references",
)
KEV_FIELDS = (
    "cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded", "shortDescription",
    "requiredAction", "dueDate", "knownRansomwareCampaignUse", "notes", "catalogVersion",
    "dateReleased", "count",
)
EPSS_FIELDS = ("cve", "epss", "percentile", "date")
EXPLOIT_FIELDS = (
    "id", "file", "description", "date_published", "author", "platform", "type", "port", "codes",
)
MODULE_FIELDS = (
    "fullname", "name", "title", "aliases", "rank", "disclosure_date", "type", "platform", "arch",
    "rport", "autofilter_ports", "autofilter_services", "targets", "mod_time", "path",
    "is_install_path", "ref_name", "check", "post_auth", "default_credential", "notes",
    "session_types", "needs_cleanup", "actions", "author", "description", "references",
)

RUN_DATE = ("year", "month", "day")
AUDIT = ("_ingested_at", "_source", "_batch_id", *RUN_DATE)

TEXT, FLAG, NUMBER, INT = StringType(), BooleanType(), DoubleType(), IntegerType()
DAY, TIME, TEXTS = DateType(), TimestampType(), ArrayType(StringType())
RUN_FIELDS = {"year": INT, "month": INT, "day": INT}
AUDIT_FIELDS = {"_ingested_at": TIME, "_source": TEXT, "_batch_id": TEXT, **RUN_FIELDS}


def _struct(fields: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def strings(names: Iterable[str]) -> StructType:
    return _struct(dict.fromkeys(names, TEXT))


def _raw(names: Iterable[str]) -> StructType:
    return _struct({**dict.fromkeys(names, TEXT), **AUDIT_FIELDS})


RAW = {
    "nvd": _raw(NVD_FIELDS),
    "kev": _raw(KEV_FIELDS),
    "epss": _raw(EPSS_FIELDS),
    "exploits": _raw(EXPLOIT_FIELDS),
    "modules": _raw(MODULE_FIELDS),
}

# Names and types of the stored columns.
CLEAN = {
    "nvd": _struct({
        "cve_id": TEXT, "sourceIdentifier": TEXT, "published_ts": TIME, "last_modified_ts": TIME,
        "vulnStatus": TEXT, "description_en": TEXT, "cvss_v31_base_score": NUMBER,
        "cvss_v31_severity": TEXT, "cvss_v31_vector": TEXT, "cvss_v31_attack_vector": TEXT,
        "cvss_v31_attack_complexity": TEXT, "primary_cwe": TEXT, "references": TEXT, **AUDIT_FIELDS,
    }),
    "kev": _struct({
        "cve_id": TEXT, "vendor_project": TEXT, "product": TEXT, "vulnerability_name": TEXT,
        "date_added": DAY, "short_description": TEXT, "required_action": TEXT, "due_date": DAY,
        "is_ransomware_related": FLAG, "notes": TEXT, "date_released": DAY, **AUDIT_FIELDS,
    }),
    "epss": _struct({
        "cve_id": TEXT, "epss_score": NUMBER, "epss_percentile": NUMBER, "score_date": DAY,
        **AUDIT_FIELDS,
    }),
    "exploits": _struct({
        "exploit_id": TEXT, "file": TEXT, "description": TEXT, "date_published_dt": DAY,
        "author": TEXT, "platform_clean": TEXT, "exploit_type": TEXT, "port_num": INT,
        "cve_ids": TEXTS, "cve_count": INT, **AUDIT_FIELDS,
    }),
    "modules": _struct({
        "fullname": TEXT, "name": TEXT, "title": TEXT, "module_type": TEXT, "platforms": TEXTS,
        "rank_label": TEXT, "rank_numeric": INT, "disclosure_date_dt": DAY, "mod_time_ts": TIME,
        "description": TEXT, "authors": TEXTS, "cve_ids": TEXTS, "cve_count": INT, "rport": TEXT,
        "check": TEXT, "post_auth": TEXT, **AUDIT_FIELDS,
    }),
}

COUNT = LongType()

# Names and types of the stored columns.
MASTER = _struct({
    "cve_id": TEXT, "sourceIdentifier": TEXT, "published_ts": TIME, "last_modified_ts": TIME,
    "vulnStatus": TEXT, "description_en": TEXT, "cvss_v31_base_score": NUMBER,
    "cvss_v31_severity": TEXT, "cvss_v31_vector": TEXT, "cvss_v31_attack_vector": TEXT,
    "cvss_v31_attack_complexity": TEXT, "primary_cwe": TEXT, "vendor_project": TEXT,
    "product": TEXT, "vulnerability_name": TEXT, "date_added": DAY, "due_date": DAY,
    "is_ransomware_related": FLAG, "required_action": TEXT, "in_cisa_kev": FLAG,
    "epss_score": NUMBER, "epss_percentile": NUMBER, "epss_score_date": DAY,
    "exploit_count": COUNT, "exploit_platforms": TEXTS,
    "exploit_types": TEXTS, "earliest_exploit_date": DAY, "msf_module_count": COUNT,
    "msf_module_types": TEXTS, "msf_max_rank": INT,
    "has_public_exploit": FLAG, "has_msf_module": FLAG, "days_since_published": INT,
    **RUN_FIELDS, "_gold_updated_at": TIME,
})

# Names and types of the stored columns.
RISK = _struct({
    "cve_id": TEXT, "description_en": TEXT, "cvss_v31_base_score": NUMBER,
    "cvss_v31_severity": TEXT, "epss_score": NUMBER, "epss_percentile": NUMBER,
    "in_cisa_kev": FLAG, "is_ransomware_related": FLAG, "has_public_exploit": FLAG,
    "exploit_count": COUNT, "has_msf_module": FLAG, "msf_module_count": COUNT,
    "composite_risk_score": NUMBER, "risk_tier": TEXT, "priority_rank": INT, "published_ts": TIME,
    "days_since_published": INT, "primary_cwe": TEXT, "vendor_project": TEXT, "product": TEXT,
    **RUN_FIELDS, "_scored_at": TIME,
})

# Names and types of the stored columns.
TRENDS = _struct({
    "trend_type": TEXT, "period": TEXT, "new_cves": COUNT, "avg_cvss": NUMBER, "avg_epss": NUMBER,
    "cisa_kev_count": COUNT, "exploitable_count": COUNT, **RUN_FIELDS, "_computed_at": TIME,
})

# Names and types of the stored columns.
READINESS = _struct({
    "cve_id": TEXT, "description_en": TEXT, "cvss_v31_severity": TEXT,
    "cvss_v31_base_score": NUMBER, "epss_score": NUMBER, "primary_cwe": TEXT, "published_ts": TIME,
    "earliest_exploit_date": DAY, "has_public_exploit": FLAG, "exploit_count": COUNT,
    "has_msf_module": FLAG, "msf_module_count": COUNT, "weaponization_level": TEXT,
    "in_cisa_kev": FLAG, "days_to_exploit": INT, "t2e_category": TEXT, **RUN_FIELDS,
    "_computed_at": TIME,
})

# Names and types of the stored columns.
KPI_HISTORY = _struct({
    "kpi_name": TEXT, "kpi_value": NUMBER, "kpi_type": TEXT, "time_window": TEXT,
    "computed_at": TIME, "computed_date": DAY, **RUN_FIELDS,
})


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns in the declared types; absent ones are NULL."""
    return df.to(schema)
