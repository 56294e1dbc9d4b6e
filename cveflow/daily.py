"""One daily run: raw tables in, cleaned tables, marts and KPI history out, as folders or as catalog tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cveflow import sinks
from cveflow.functions import values as v
from cveflow.plans import clean, kpis, master, readiness, risk, trends
from cveflow.schema import CLEAN

def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    *,
    as_of: dt.date | str,
    now: dt.datetime | str | None = None,
    previous: str | None = None,
    tiebreak: list[str] | None = None,
) -> dict[str, str]:
    """Write every table of the run under ``root/run=<date>`` and return their paths.

    Each layer reads the stored tables of the layer before it.  ``previous`` is the folder of the
    run before; ``raw`` then needs only the rows that came since: cleaned tables are carried forward
    and master and risk are upserted.  KPI rows are appended under ``root/kpis``.
    """
    home = f"{root.rstrip('/')}/run={v.as_date(as_of)}"
    paths: dict[str, str] = {}

    def before(name: str, schema: StructType) -> DataFrame | None:
        return spark.read.schema(schema).parquet(f"{previous}/{name}") if previous else None

    def cleaned(feed: str) -> DataFrame:
        old = before(feed, CLEAN[feed])
        if old is None:
            return getattr(clean, feed)(raw[feed], tiebreak=tiebreak)
        return clean.update(feed, old, raw[feed], tiebreak=tiebreak)

    def store(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{home}/{name}"
        sinks.overwrite(df, paths[name], rebalance=True)
        return spark.read.schema(df.schema).parquet(paths[name])

    def store_mart(name: str, df: DataFrame, cluster_by: str) -> DataFrame:
        paths[name] = f"{home}/{name}"
        old = before(name, df.schema)
        merged = df if old is None else sinks.upsert(old, df, ["cve_id"])
        sinks.clustered(merged, paths[name], cluster_by=cluster_by, partition_by=("year", "month", "day"))
        return spark.read.schema(df.schema).parquet(paths[name])

    tables = {feed: store(feed, cleaned(feed)) for feed in CLEAN}
    wide = store_mart(
        "master", master.build(**tables, as_of=as_of, now=now, tiebreak=tiebreak), "cve_id"
    )
    scored = store_mart("risk", risk.score(wide, as_of=as_of, now=now), "composite_risk_score")
    store("exploit_ids", v.run_date(master.exploit_ids(tables["exploits"]), as_of))
    store("module_names", v.run_date(master.module_names(tables["modules"]), as_of))
    store("trends", trends.combined(wide, as_of=as_of, now=now))
    store("readiness", readiness.build(wide, as_of=as_of, now=now))
    paths["kpis"] = f"{root.rstrip('/')}/kpis"
    long = kpis.to_long(kpis.snapshot(wide, scored, as_of=as_of), as_of=as_of, now=now)
    sinks.append(long, paths["kpis"])
    return paths


def run_tables(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    database: str,
    *,
    as_of: dt.date | str,
    now: dt.datetime | str | None = None,
    tiebreak: list[str] | None = None,
) -> list[str]:
    """One run into the catalog tables of ``database``, which are created if absent and merged into otherwise.

    Every table is switched to its new version at once; a run that was killed is simply run again.
    ``raw`` needs only the rows that came since the last run.  Returns the names of all tables.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names: list[str] = []

    def table(name: str) -> str:
        names.append(f"{database}.{name}")
        return names[-1]

    def swap(name: str, df: DataFrame) -> DataFrame:
        target = table(name)
        sinks.publish(df, target)
        return spark.table(target).select(*df.columns)

    def cleaned(feed: str) -> DataFrame:
        if not sinks.exists(spark, f"{database}.{feed}"):
            return getattr(clean, feed)(raw[feed], tiebreak=tiebreak)
        old = spark.table(f"{database}.{feed}").select(*CLEAN[feed].names)
        return clean.update(feed, old, raw[feed], tiebreak=tiebreak)

    def merged(name: str, df: DataFrame, cluster_by: str) -> DataFrame:
        sinks.merge_table(df, table(name), ["cve_id"], cluster_by=cluster_by)
        return spark.table(names[-1]).select(*df.columns)

    tables = {feed: swap(feed, cleaned(feed)) for feed in CLEAN}
    wide = merged("master", master.build(**tables, as_of=as_of, now=now, tiebreak=tiebreak), "cve_id")
    scored = merged("risk", risk.score(wide, as_of=as_of, now=now), "composite_risk_score")
    swap("exploit_ids", v.run_date(master.exploit_ids(tables["exploits"]), as_of))
    swap("module_names", v.run_date(master.module_names(tables["modules"]), as_of))
    swap("trends", trends.combined(wide, as_of=as_of, now=now))
    swap("readiness", readiness.build(wide, as_of=as_of, now=now))
    long = kpis.to_long(kpis.snapshot(wide, scored, as_of=as_of), as_of=as_of, now=now)
    sinks.append(long, table("kpis"))
    return names
