"""Composite risk score, tier and priority rank."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cveflow.functions import values as v
from cveflow.operators.dedup import dense_rank_by_value

# Share of each component in the score.
WEIGHTS = {
    "cvss": 0.30, "epss": 0.25, "kev": 0.20, "exploit": 0.10, "msf": 0.10, "ransomware": 0.05,
}
# Lowest score of each tier; anything lower is LOW.
TIERS = (("CRITICAL", 0.75), ("HIGH", 0.50), ("MEDIUM", 0.25))

# Columns of the risk table.
COLUMNS = (
    "cve_id", "description_en", "cvss_v31_base_score", "cvss_v31_severity", "epss_score",
    "epss_percentile", "in_cisa_kev", "is_ransomware_related", "has_public_exploit",
    "exploit_count", "has_msf_module", "msf_module_count", "composite_risk_score", "risk_tier",
    "priority_rank", "published_ts", "days_since_published", "primary_cwe", "vendor_project",
    "product",
)

SCORE = "composite_risk_score"


def most_scores(weights: Mapping[str, float] = WEIGHTS) -> int:
    """How many scores there can be: four places between the least and the greatest sum, and NULL."""
    return math.ceil(sum(map(abs, weights.values())) * 10_000) + 3


def composite(weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted sum rounded to four places.

    CVSS counts as a value in [0, 10] and EPSS as one in [0, 1], so that the weights bound the score.
    """

    def flag(name: str) -> Column:
        return F.when(F.col(name), 1.0).otherwise(0.0)

    total = (
        v.clamp(F.col("cvss_v31_base_score"), 10.0) / 10.0 * weights["cvss"]
        + v.clamp01(F.col("epss_score")) * weights["epss"]
        + flag("in_cisa_kev") * weights["kev"]
        + flag("has_public_exploit") * weights["exploit"]
        + flag("has_msf_module") * weights["msf"]
        + flag("is_ransomware_related") * weights["ransomware"]
    )
    return F.round(total, 4)


def tier(score: Column) -> Column:
    label = F.lit("LOW")
    for name, floor in reversed(TIERS):
        label = F.when(score >= floor, name).otherwise(label)
    return label


def score(
    master: DataFrame,
    *,
    as_of: dt.date | str | None = None,
    now: dt.datetime | str | None = None,
    weights: Mapping[str, float] = WEIGHTS,
) -> DataFrame:
    """Risk table: 20 columns of the master plus score, tier, rank and the run stamp."""
    inputs = [c for c in COLUMNS if c not in (SCORE, "risk_tier", "priority_rank")]
    scored = master.select(*inputs).withColumn(SCORE, composite(weights))
    ranked = dense_rank_by_value(scored, SCORE, "priority_rank", most=most_scores(weights)).withColumn("risk_tier", tier(F.col(SCORE))).select(*COLUMNS)
    return v.stamped(ranked, as_of, now, "_scored_at")


def tier_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_tier").count().orderBy("risk_tier")
