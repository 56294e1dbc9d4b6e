"""The registered queries: every operator over the whole of the given tables.

Operators on raw and cleaned rows run straight from the source tables.  Operators on marts read the
stored mart, as in a daily run; each mart is built and written once per session and folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, TimestampType

from cveflow import schema, scratch, sinks
from cveflow.functions import ids, values as v
from cveflow.operators import dedup
from cveflow.oracle.sql import (
    FIRST_RUN, KPI_DAYS, SPLIT_CHANGED, SPLIT_NEW,
)
from cveflow.plans import clean, kpis, master, readiness, risk, trend_state, trends, views
from cveflow.sources import feeds, planning, testfeeds
from cveflow.streaming import ingest

AS_OF, TIES = testfeeds.AS_OF, testfeeds.TIEBREAK

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[["Tables"], DataFrame]], Query]:
    """Register a query; its output is flattened to types that compare across engines."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(build(Tables.of(spark, sf_dir)))

        QUERIES[name] = run
        return run

    return register


def flat(df: DataFrame) -> DataFrame:
    """Dates and times as text, lists joined with commas, doubles rounded to eight places."""

    def plain(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(field.dataType, DoubleType):
            c = F.round(c, 8)
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


class Tables:
    """Raw feeds, cleaned tables and stored marts of one source folder."""

    _open: dict[tuple[str, str], "Tables"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._marts = spark, sf_dir, {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        key = (spark.sparkContext.applicationId, sf_dir)
        tables = cls._open.setdefault(key, cls(spark, sf_dir))
        tables.spark = spark
        return tables

    def raw(self, feed: str) -> DataFrame:
        return testfeeds.raw(self.spark, self.sf_dir, feed)

    def nvd(self) -> DataFrame:
        return clean.nvd(self.raw("nvd"), tiebreak=TIES)

    def kev(self) -> DataFrame:
        return clean.kev(self.raw("kev"), tiebreak=TIES)

    def epss(self) -> DataFrame:
        return clean.epss(self.raw("epss"), tiebreak=TIES)

    def exploits(self) -> DataFrame:
        return clean.exploits(self.raw("exploits"), tiebreak=TIES)

    def modules(self) -> DataFrame:
        return clean.modules(self.raw("modules"), tiebreak=TIES)

    def build_master(self) -> DataFrame:
        return master.build(
            self.nvd(), self.kev(), clean.epss_rows(self.raw("epss")), self.exploits(),
            self.modules(), as_of=AS_OF, tiebreak=TIES,
        )

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._marts:
            self._marts[name] = scratch.stored(build(), name)
        return self._marts[name]

    def master(self) -> DataFrame:
        return self._stored("master", self.build_master)

    def risk(self) -> DataFrame:
        return self._stored("risk", lambda: risk.score(self.master(), as_of=AS_OF))

    def readiness(self) -> DataFrame:
        return self._stored("readiness", lambda: readiness.build(self.master(), as_of=AS_OF))

    def trends(self) -> DataFrame:
        return self._stored("trends", lambda: trends.combined(self.master(), as_of=AS_OF))

    def runs(self, table: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of two runs: the second has those that changed and those that are new."""
        published = F.to_date("published_ts")
        early = F.coalesce(published < F.lit(SPLIT_NEW).cast("date"), F.lit(True))
        before = v.run_date(table.where(early), FIRST_RUN)
        return before, v.run_date(table.where(published >= F.lit(SPLIT_CHANGED).cast("date")), AS_OF)

    def two_runs(self, table: DataFrame) -> DataFrame:
        """The mart after two runs: the second replaces what changed and adds what is new."""
        before, changed = self.runs(table)
        return sinks.upsert(before, changed, ["cve_id"])

    def partitioned(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stored mart with run-date partitions."""
        if name not in self._marts:
            df, path = build(), scratch.fresh_path(self.spark, name)
            sinks.overwrite(df, path)
            self._marts[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._marts[name]

    def risk_runs(self) -> DataFrame:
        return self.partitioned("risk_runs", lambda: self.two_runs(self.risk()))

    def readiness_runs(self) -> DataFrame:
        return self.partitioned("readiness_runs", lambda: self.two_runs(self.readiness()))

    def kpi_history(self) -> DataFrame:
        if "kpis" not in self._marts:
            path = scratch.fresh_path(self.spark, "kpis")
            for day in KPI_DAYS:
                wide = kpis.snapshot(self.master(), v.run_date(self.risk(), day), as_of=day)
                sinks.append(kpis.to_long(wide, as_of=day), path)
            self._marts["kpis"] = self.spark.read.schema(schema.KPI_HISTORY).parquet(path)
        return self._marts["kpis"]


# --- Sources -------------------------------------------------------------------------------------
# The reader queries first write the feed in its published file format, then read it back.  A
# document holds the records of a fixed range of numbers, so it stays bounded at any table size.

def _documents(df: DataFrame, name: str) -> str:
    """Write a one-column text frame, one document per line; returns the folder."""
    path = scratch.fresh_path(df.sparkSession, name)
    df.write.text(path)
    return path


def _number(c: Column) -> Column:
    return F.regexp_extract(F.trim(c), "([0-9]+)$", 1).cast("long")


def _block(c: Column, size: int) -> Column:
    return F.floor(c / size)


def _object(texts: list[str], nested: list[str] = ()) -> Column:
    """JSON text of the named columns; ``nested`` ones hold JSON already."""
    plain = F.to_json(F.struct(*[F.col(f"`{c}`") for c in texts]), {"ignoreNullFields": "false"})
    parts = [F.concat(F.lit(f',"{c}":'), F.col(f"`{c}`")) for c in nested]
    return F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), *parts, F.lit("}"))


def _joined(c: Column) -> Column:
    return F.array_join(F.collect_list(c), ",")


@query("q_read_nvd")
def q_read_nvd(t: Tables) -> DataFrame:
    texts = ["id", "sourceIdentifier", "published", "lastModified", "vulnStatus"]
    nested = ["descriptions", "metrics", "weaknesses", "references"]
    record = F.concat(F.lit('{"cve":'), _object(texts, nested), F.lit("}"))
    raw = t.raw("nvd")
    pages = raw.groupBy(_block(_number(raw["id"]), planning.PAGE_ROWS)).agg(
        F.concat(
            F.lit('{"totalResults":'), F.count("*").cast("string"), F.lit(',"vulnerabilities":['),
            _joined(record), F.lit("]}"),
        ).alias("value")
    )
    path = _documents(pages.select("value"), "nvd")
    return feeds.read_nvd(t.spark, path, lines=True).select(*schema.NVD_FIELDS)


@query("q_read_kev")
def q_read_kev(t: Tables) -> DataFrame:
    texts = [
        "cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded", "requiredAction",
        "dueDate", "knownRansomwareCampaignUse", "shortDescription", "notes",
    ]
    raw, header = t.raw("kev"), ["catalogVersion", "dateReleased"]
    catalogues = raw.groupBy(*header, _block(_number(raw["cveID"]), 1000)).agg(
        F.count("*").cast("string").alias("count"), _joined(_object(texts)).alias("entries")
    )
    catalogues = catalogues.withColumn("vulnerabilities", F.concat(F.lit("["), F.col("entries"), F.lit("]"))).select(
        _object([*header, "count"], ["vulnerabilities"]).alias("value")
    )
    path = _documents(catalogues.select("value"), "kev")
    return feeds.read_kev(t.spark, path, lines=True).select(*texts, *header, "count")


@query("q_read_epss")
def q_read_epss(t: Tables) -> DataFrame:
    """One gzip file per day and block of advisories, in a folder of the day."""
    rows = t.raw("epss").select(
        "date",
        _block(_number(F.col("cve")), 10_000_000).alias("block"),
        F.lit(2).alias("part"),
        F.concat_ws(",", "cve", "epss", "percentile").alias("value"),
    )
    files = rows.select("date", "block").distinct()
    comment = F.concat(F.lit("#model_version:v1,score_date:"), "date", F.lit("T00:00:00+0000"))
    lines = (
        rows.unionByName(files.select("date", "block", F.lit(0).alias("part"), comment.alias("value")))
        .unionByName(files.select("date", "block", F.lit(1).alias("part"), F.lit("cve,epss,percentile").alias("value")))
    )
    path = scratch.fresh_path(t.spark, "epss")
    (
        lines.repartition("date", "block").sortWithinPartitions("date", "block", "part").drop("part")
        .write.partitionBy("date", "block").text(path, compression="gzip")
    )
    return feeds.read_epss(t.spark, path, dated=True)


@query("q_read_exploits")
def q_read_exploits(t: Tables) -> DataFrame:
    path = scratch.fresh_path(t.spark, "exploits")
    t.raw("exploits").select(*schema.EXPLOIT_FIELDS).write.csv(
        path, header=True, quoteAll=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return feeds.read_exploits(t.spark, path)


@query("q_read_quoted")
def q_read_quoted(t: Tables) -> DataFrame:
    """The exploit index with a newline, quotes and a comma inside every description, read back in splits."""
    path = scratch.fresh_path(t.spark, "quoted")
    told = F.concat(F.lit('say "'), "description", F.lit('",\n\nthen '), "id")
    t.raw("exploits").select(*[told.alias(c) if c == "description" else c for c in schema.EXPLOIT_FIELDS]).write.csv(
        path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return feeds.read_exploits(t.spark, path, multiline=True)


@query("q_read_modules")
def q_read_modules(t: Tables) -> DataFrame:
    texts = ["name", "title", "rank", "disclosure_date", "type", "mod_time"]
    nested = ["platform", "author", "references"]
    raw = t.raw("modules")
    entry = F.concat(F.lit('"'), F.col("fullname"), F.lit('":'), _object(texts, nested))
    block = _block(_number(raw["name"]), 500), _number(raw["fullname"])
    maps = raw.groupBy(*block).agg(F.concat(F.lit("{"), _joined(entry), F.lit("}")).alias("value"))
    path = _documents(maps.select("value"), "modules")
    return feeds.read_modules(t.spark, path, lines=True).select(*schema.MODULE_FIELDS)


@query("q_stamp")
def q_stamp(t: Tables) -> DataFrame:
    fields = t.raw("epss").select(*schema.EPSS_FIELDS)
    return feeds.stamp(fields, now=f"{AS_OF} 06:30:00", source="epss_api", batch_id="batch-1")


@query("q_plan_windows")
def q_plan_windows(t: Tables) -> DataFrame:
    raw = t.raw("nvd")
    since = raw.agg(F.min(F.try_to_timestamp("lastModified")).cast("date")).first()[0]
    totals = planning.count_by_window(raw, since, AS_OF)
    windows = planning.plan_windows(t.spark, since, AS_OF).join(totals, "window_start")
    return planning.plan_offsets(windows)


@query("q_high_water")
def q_high_water(t: Tables) -> DataFrame:
    return planning.high_water_mark(t.raw("nvd"))


@query("q_top_up")
def q_top_up(t: Tables) -> DataFrame:
    raw, columns = t.raw("nvd"), ["id", "published", "lastModified", "vulnStatus", "_source"]
    own = raw.where("_source = 'nvd_api'").select(*columns)
    extra = raw.where("_source = 'synthetic'").select("id", "published", "_source")
    return feeds.top_up(own, extra)


@query("q_incremental")
def q_incremental(t: Tables) -> DataFrame:
    """Two deliveries of files, one run after each; the second run sees only the new files."""
    inbox, table, state = (scratch.fresh_path(t.spark, n) for n in ("inbox", "table", "state"))
    raw = t.raw("nvd").drop("year", "month", "day")
    for delivery in ("_batch_id = '0'", "_batch_id <> '0'"):
        raw.where(delivery).write.mode("append").parquet(inbox)
        ingest.ingest_incremental(
            t.spark, inbox, raw.schema, ingest.to_table(table), checkpoint=state, fmt="parquet"
        ).awaitTermination()
    return ingest.read_table(t.spark, table, raw.schema).select("id", "lastModified", "_batch_id")


@query("q_stream_upsert")
def q_stream_upsert(t: Tables) -> DataFrame:
    """Two deliveries into a keyed table; the second run has lost its checkpoint and gets all files again."""
    inbox, table = (scratch.fresh_path(t.spark, n) for n in ("inbox", "keyed"))
    rows = clean.nvd_rows(t.raw("nvd")).select("cve_id", "last_modified_ts", "_ingested_at", "_batch_id")
    write = ingest.to_keyed(table, ["cve_id"], ["last_modified_ts", "_ingested_at"], buckets=8, tiebreak=TIES)
    for delivery in ("_batch_id = '0'", "_batch_id <> '0'"):
        rows.where(delivery).write.mode("append").parquet(inbox)
        ingest.ingest_incremental(
            t.spark, inbox, rows.schema, write, checkpoint=scratch.fresh_path(t.spark, "state"), fmt="parquet", file="_file"
        ).awaitTermination()
    return ingest.read_keyed(t.spark, table)


# --- Sinks ---------------------------------------------------------------------------------------

@query("q_append_roundtrip")
def q_append_roundtrip(t: Tables) -> DataFrame:
    path, rows = scratch.fresh_path(t.spark, "append"), clean.kev_rows(t.raw("kev"))
    for delivery in ("_batch_id = '0'", "_batch_id <> '0'"):
        sinks.append(rows.where(delivery), path)
    back = t.spark.read.schema(rows.schema).parquet(path)
    return back.select("cve_id", "date_added", "due_date", *schema.RUN_DATE)


@query("q_overwrite_roundtrip")
def q_overwrite_roundtrip(t: Tables) -> DataFrame:
    path, rows = scratch.fresh_path(t.spark, "overwrite"), t.nvd()
    sinks.overwrite(t.kev(), path)
    sinks.overwrite(rows, path)
    back = t.spark.read.schema(rows.schema).parquet(path)
    return back.select("cve_id", "last_modified_ts", *schema.RUN_DATE)


@query("q_clustered_write")
def q_clustered_write(t: Tables) -> DataFrame:
    path, table = scratch.fresh_path(t.spark, "clustered"), t.master()
    sinks.clustered(table, path, cluster_by="cve_id")
    return t.spark.read.schema(table.schema).parquet(path).select("cve_id", "published_ts", "epss_score")


@query("q_upsert")
def q_upsert(t: Tables) -> DataFrame:
    return t.two_runs(t.risk()).select(*risk.COLUMNS, *schema.RUN_DATE)


@query("q_merge_changes")
def q_merge_changes(t: Tables) -> DataFrame:
    """Two runs into a versioned table; the second gives all advisories of its run, and an earlier row of it stays where nothing changed."""
    path = scratch.fresh_path(t.spark, "merged")
    for rows in t.runs(t.risk()):
        sinks.merge_table(rows, path, ["cve_id"], cluster_by="composite_risk_score")
    return sinks.read(t.spark, path).select(*risk.COLUMNS, *schema.RUN_DATE)


@query("q_compact")
def q_compact(t: Tables) -> DataFrame:
    """Many small appends, packed into few files."""
    path, rows = scratch.fresh_path(t.spark, "small"), clean.kev_rows(t.raw("kev"))
    for part in range(4):
        sinks.append(rows.where(F.pmod(F.xxhash64("cve_id"), F.lit(4)) == part), path)
    sinks.compact(t.spark, path, partition_by=schema.RUN_DATE)
    return sinks.read(t.spark, path).select("cve_id", "date_added", "due_date", *schema.RUN_DATE)


@query("q_partition_scan")
def q_partition_scan(t: Tables) -> DataFrame:
    return views.on_partition(t.risk_runs(), AS_OF).select(*risk.COLUMNS, *schema.RUN_DATE)


# --- Cleaning ------------------------------------------------------------------------------------

@query("q_clean_ids")
def q_clean_ids(t: Tables) -> DataFrame:
    raw = t.raw("nvd").select("id", ids.normalise("id").alias("cve_id"), "_batch_id")
    return raw.where(ids.is_valid("cve_id"))


@query("q_json_extract")
def q_json_extract(t: Tables) -> DataFrame:
    return clean.nvd_rows(t.raw("nvd")).select(
        "cve_id", "description_en", "cvss_v31_base_score", "cvss_v31_severity", "cvss_v31_vector",
        "cvss_v31_attack_vector", "cvss_v31_attack_complexity", "primary_cwe", "_batch_id",
    )


@query("q_parse_dates")
def q_parse_dates(t: Tables) -> DataFrame:
    return t.raw("kev").select(
        "cveID", v.day(F.col("dateAdded")).alias("date_added"),
        v.day(F.col("dueDate")).alias("due_date"), "_batch_id",
    )


@query("q_clamp")
def q_clamp(t: Tables) -> DataFrame:
    return t.raw("epss").select(
        "cve", "_batch_id", v.clamp01(v.number(F.col("epss"))).alias("epss_score"),
        v.clamp01(v.number(F.col("percentile"))).alias("epss_percentile"),
    )


@query("q_extract_codes")
def q_extract_codes(t: Tables) -> DataFrame:
    found = t.raw("exploits").select("file", "id", ids.extract_list("codes").alias("cve_ids"))
    return found.withColumn("cve_count", F.size("cve_ids"))


@query("q_json_arrays")
def q_json_arrays(t: Tables) -> DataFrame:
    return t.raw("modules").select(
        "fullname", v.text_list(F.col("platform")).alias("platforms"),
        v.text_list(F.col("author")).alias("authors"),
        v.text_list(F.col("references")).alias("refs"),
    )


@query("q_rank_map")
def q_rank_map(t: Tables) -> DataFrame:
    return clean.module_rows(t.raw("modules")).select("fullname", "rank_label", "rank_numeric")


@query("q_clean_nvd")
def q_clean_nvd(t: Tables) -> DataFrame:
    return t.nvd().drop("_ingested_at", *schema.RUN_DATE)


@query("q_clean_kev")
def q_clean_kev(t: Tables) -> DataFrame:
    return t.kev().drop("_ingested_at", "_source", *schema.RUN_DATE)


@query("q_clean_epss")
def q_clean_epss(t: Tables) -> DataFrame:
    return t.epss().drop("_ingested_at", "_source", *schema.RUN_DATE)


@query("q_clean_exploits")
def q_clean_exploits(t: Tables) -> DataFrame:
    return t.exploits().drop(*schema.AUDIT)


@query("q_clean_modules")
def q_clean_modules(t: Tables) -> DataFrame:
    return t.modules().drop(*schema.AUDIT)


# --- Newest row per key --------------------------------------------------------------------------

@query("q_latest_nvd")
def q_latest_nvd(t: Tables) -> DataFrame:
    rows = clean.nvd_rows(t.raw("nvd")).select("cve_id", "last_modified_ts", "_ingested_at", "_batch_id")
    return dedup.latest_by(rows, ["cve_id"], ["last_modified_ts", "_ingested_at"], tiebreak=TIES)


@query("q_latest_kev")
def q_latest_kev(t: Tables) -> DataFrame:
    rows = clean.kev_rows(t.raw("kev")).select("cve_id", "_ingested_at", "_batch_id")
    return dedup.latest_by(rows, ["cve_id"], ["_ingested_at"], tiebreak=TIES)


@query("q_latest_epss_day")
def q_latest_epss_day(t: Tables) -> DataFrame:
    rows = clean.epss_rows(t.raw("epss")).select("cve_id", "score_date", "_ingested_at", "_batch_id")
    return dedup.latest_by(rows, ["cve_id", "score_date"], ["_ingested_at"], tiebreak=TIES)


@query("q_latest_exploit")
def q_latest_exploit(t: Tables) -> DataFrame:
    rows = t.raw("exploits").where(v.non_empty(F.col("id"))).select("id", "_ingested_at", "_batch_id")
    return dedup.latest_by(rows, ["id"], ["_ingested_at"], tiebreak=TIES)


@query("q_latest_module")
def q_latest_module(t: Tables) -> DataFrame:
    rows = t.raw("modules").select("fullname", "_ingested_at", "_batch_id")
    return dedup.latest_by(rows, ["fullname"], ["_ingested_at"], tiebreak=TIES)


@query("q_epss_latest")
def q_epss_latest(t: Tables) -> DataFrame:
    return master.latest_epss(clean.epss_rows(t.raw("epss")), tiebreak=TIES)


# --- Master --------------------------------------------------------------------------------------

@query("q_explode_exploits")
def q_explode_exploits(t: Tables) -> DataFrame:
    return master.exploit_links(t.exploits())


@query("q_explode_modules")
def q_explode_modules(t: Tables) -> DataFrame:
    return master.module_links(t.modules())


@query("q_exploit_ids")
def q_exploit_ids(t: Tables) -> DataFrame:
    return master.exploit_ids(t.exploits())


@query("q_module_names")
def q_module_names(t: Tables) -> DataFrame:
    return master.module_names(t.modules())


@query("q_exploit_rollup")
def q_exploit_rollup(t: Tables) -> DataFrame:
    return master.exploit_rollup(t.exploits())


@query("q_module_rollup")
def q_module_rollup(t: Tables) -> DataFrame:
    return master.module_rollup(t.modules())


@query("q_master")
def q_master(t: Tables) -> DataFrame:
    return t.build_master().drop("_gold_updated_at", *schema.RUN_DATE)


@query("q_age_days")
def q_age_days(t: Tables) -> DataFrame:
    return t.nvd().select(
        "cve_id", master.age_days(F.col("published_ts"), AS_OF).alias("days_since_published")
    )


# --- Risk ----------------------------------------------------------------------------------------

@query("q_risk")
def q_risk(t: Tables) -> DataFrame:
    return risk.score(t.master(), as_of=AS_OF).select(*risk.COLUMNS)


@query("q_priority_rank")
def q_priority_rank(t: Tables) -> DataFrame:
    scored = t.master().select("cve_id", risk.composite().alias(risk.SCORE))
    return dedup.dense_rank_by_value(scored, risk.SCORE, "priority_rank", most=risk.most_scores())


@query("q_rank_of_any")
def q_rank_of_any(t: Tables) -> DataFrame:
    """Rank of every revision by its time, of which there are as many as rows."""
    rows = clean.nvd_rows(t.raw("nvd")).select("cve_id", "last_modified_ts", "_batch_id")
    return dedup.dense_rank_of_any(rows, "last_modified_ts", "recency_rank")


@query("q_tier_distribution")
def q_tier_distribution(t: Tables) -> DataFrame:
    return risk.tier_distribution(t.risk())


@query("q_top10")
def q_top10(t: Tables) -> DataFrame:
    return kpis.top_risks(views.on_partition(t.risk(), AS_OF))


# --- Trends --------------------------------------------------------------------------------------

@query("q_trend_daily")
def q_trend_daily(t: Tables) -> DataFrame:
    return trends.daily(t.master())


@query("q_trend_weekly")
def q_trend_weekly(t: Tables) -> DataFrame:
    return trends.weekly(t.master())


@query("q_trend_monthly")
def q_trend_monthly(t: Tables) -> DataFrame:
    return trends.monthly(t.master())


@query("q_severity_by_year")
def q_severity_by_year(t: Tables) -> DataFrame:
    return trends.severity_by_year(t.master())


@query("q_cwe_trend")
def q_cwe_trend(t: Tables) -> DataFrame:
    return trends.cwe_by_year(t.master())


@query("q_trends")
def q_trends(t: Tables) -> DataFrame:
    return trends.combined(t.master(), as_of=AS_OF).select("trend_type", "period", *trends.COMMON)


@query("q_trends_kept_up")
def q_trends_kept_up(t: Tables) -> DataFrame:
    """Trends of a first run, brought up to date by the advisories that the second run moved to other days, rescored or added."""
    now = t.master()
    third, new = (F.pmod(F.xxhash64("cve_id"), F.lit(n)) == 0 for n in (3, 5))
    before = now.where(~new).withColumns({
        "published_ts": F.when(third, F.col("published_ts") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("published_ts")),
        "cvss_v31_base_score": F.when(~third, F.col("cvss_v31_base_score")), "in_cisa_kev": third})
    changes = now
    days = trend_state.advance(trend_state.state(before), trend_state.replaced(before, changes), changes)
    return trend_state.combined(days).select("trend_type", "period", *trends.COMMON)


# --- Readiness -----------------------------------------------------------------------------------

@query("q_readiness")
def q_readiness(t: Tables) -> DataFrame:
    return readiness.build(t.master(), as_of=AS_OF).drop("_computed_at", *schema.RUN_DATE)


@query("q_time_to_exploit")
def q_time_to_exploit(t: Tables) -> DataFrame:
    timed = readiness.time_to_exploit(t.master())
    return timed.select("cve_id", "earliest_exploit_date", "time_to_exploit_days")


@query("q_tte_stats")
def q_tte_stats(t: Tables) -> DataFrame:
    return readiness.tte_stats(t.master(), exact=True)


@query("q_readiness_by_severity")
def q_readiness_by_severity(t: Tables) -> DataFrame:
    return readiness.by_severity(t.master())


@query("q_readiness_by_cwe")
def q_readiness_by_cwe(t: Tables) -> DataFrame:
    return readiness.by_cwe(t.master())


@query("q_readiness_overview")
def q_readiness_overview(t: Tables) -> DataFrame:
    return readiness.overview(t.master())


# --- KPIs and reports ----------------------------------------------------------------------------

@query("q_kpi_snapshot")
def q_kpi_snapshot(t: Tables) -> DataFrame:
    return kpis.snapshot(t.master(), t.risk(), as_of=AS_OF)


@query("q_kpi_long")
def q_kpi_long(t: Tables) -> DataFrame:
    long = kpis.to_long(kpis.snapshot(t.master(), t.risk(), as_of=AS_OF), as_of=AS_OF)
    return long.drop("computed_at", *schema.RUN_DATE)


@query("q_mom")
def q_mom(t: Tables) -> DataFrame:
    return kpis.month_over_month(t.master(), as_of=AS_OF)


@query("q_weaponization")
def q_weaponization(t: Tables) -> DataFrame:
    return kpis.weaponization(views.on_partition(t.readiness(), AS_OF))


@query("q_vendor_risk")
def q_vendor_risk(t: Tables) -> DataFrame:
    return kpis.vendor_risk(t.master())


@query("q_cwe_summary")
def q_cwe_summary(t: Tables) -> DataFrame:
    return kpis.cwe_summary(t.master())


@query("q_alerts")
def q_alerts(t: Tables) -> DataFrame:
    return kpis.alerts(t.master(), as_of=AS_OF)


# --- Views ---------------------------------------------------------------------------------------

@query("q_view_latest_kpis")
def q_view_latest_kpis(t: Tables) -> DataFrame:
    return views.latest_kpis(t.kpi_history())


@query("q_view_kpi_history")
def q_view_kpi_history(t: Tables) -> DataFrame:
    return views.kpi_history(t.kpi_history(), as_of=AS_OF)


@query("q_view_top_risks")
def q_view_top_risks(t: Tables) -> DataFrame:
    return views.top_risks(t.risk_runs())


@query("q_view_daily_trends")
def q_view_daily_trends(t: Tables) -> DataFrame:
    return views.daily_trends(t.trends(), as_of=AS_OF)


@query("q_view_monthly_trends")
def q_view_monthly_trends(t: Tables) -> DataFrame:
    return views.monthly_trends(t.trends(), as_of=AS_OF)


@query("q_view_weaponization")
def q_view_weaponization(t: Tables) -> DataFrame:
    return views.weaponization(t.readiness_runs())


@query("q_view_critical_alerts")
def q_view_critical_alerts(t: Tables) -> DataFrame:
    return views.critical_alerts(t.master(), as_of=AS_OF)


@query("q_view_vendor_risk")
def q_view_vendor_risk(t: Tables) -> DataFrame:
    return views.vendor_risk(t.master())
