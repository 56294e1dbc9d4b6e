"""Plan shapes that matter on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from cveflow import clean, dedup, kpis, master, merge, registry, risk, scratch, sinks, testfeeds, trends, views

QUERIES = registry.QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_newest_row_is_limited_before_the_shuffle(tables):
    for feed in ("nvd", "kev", "epss", "exploits", "modules"):
        text = plan(getattr(tables, feed)())
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_latest_epss_from_rows_shuffles_once(tables):
    text = plan(master.latest_epss(clean.epss_rows(tables.raw("epss"))))
    assert text.count("ENSURE_REQUIREMENTS") == 1


def test_master_joins_add_no_shuffle(spark, tables):
    """From stored cleaned tables: one scan and one exchange for each of the five."""
    stored = {f: scratch.stored(getattr(tables, f)(), f) for f in ("nvd", "kev", "epss", "exploits", "modules")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(master.build(**stored, as_of=testfeeds.AS_OF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert len(exchanges) == 5 and {re.sub(r"#\d+L?", "", e) for e in exchanges} == {"cve_id"}
    assert text.count("FileScan") == 5


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_master_rows_are_not_moved_to_be_ranked(tables):
    scored = tables.master().select("cve_id", risk.composite().alias(risk.SCORE))
    for df in (risk.score(tables.master(), as_of=testfeeds.AS_OF), dedup.dense_rank_by_value(scored, risk.SCORE, "r", most=10_004)):
        text = executed(df)
        probe, build = text.split("BroadcastQueryStage" if "BroadcastQueryStage" in text else "BroadcastExchange", 1)
        assert "BroadcastHashJoin" in probe and text.count("FileScan") == 2
        single = re.search(r"Exchange SinglePartition.*\n[^\n]*", build)
        assert single and "Exchange" not in build.split("FileScan")[1]


def test_first_load_and_merge_check_narrow_keys(spark, tables):
    for target in (None, tables.risk()):
        text = plan(merge.upsert(target, tables.risk(), ["cve_id"]))
        assert "Window" not in text


def test_trends_scan_the_master_once(tables):
    assert plan(trends.combined(tables.master(), as_of=testfeeds.AS_OF)).count("FileScan") == 1


def test_snapshot_scans_each_table_once(tables):
    assert plan(kpis.snapshot(tables.master(), tables.risk(), as_of=testfeeds.AS_OF)).count("FileScan") == 2


def test_date_filters_reach_the_reader_and_columns_are_pruned(tables):
    text = tables_text = plan(kpis.alerts(tables.master(), as_of=testfeeds.AS_OF))
    assert "GreaterThanOrEqual(published_ts" in text
    schema = re.search(r"ReadSchema: struct<(.*?)\n", tables_text).group(1)
    assert "exploit_types" not in schema and "last_modified_ts" not in schema


def test_run_date_prunes_partitions(spark, tables):
    text = plan(views.on_partition(tables.risk_runs(), testfeeds.AS_OF))
    assert "PartitionFilters: [isnotnull(year" in text


def test_newest_run_subquery_prunes_partitions(tables):
    scan = next(line for line in plan(views.top_risks(tables.risk_runs())).splitlines() if "FileScan" in line)
    assert "PartitionFilters: []" not in scan


def test_top_k_is_not_a_full_sort(tables):
    for df in (kpis.top_risks(tables.risk()), kpis.vendor_risk(tables.master()), kpis.cwe_summary(tables.master())):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_clustered_files_skip(spark, tables, tmp_path):
    path = str(tmp_path / "c")
    seen = sinks.clustered(tables.master(), path, cluster_by="cve_id", partitions=6)
    back = spark.read.parquet(path)
    assert seen.get["rows"] == tables.master().count() == back.count()
    ranges = back.groupBy(F.input_file_name().alias("f")).agg(F.min("cve_id").alias("lo"), F.max("cve_id").alias("hi"))
    rows = sorted((r.lo, r.hi) for r in ranges.collect())
    assert len(rows) > 1 and all(a[1] <= b[0] for a, b in zip(rows, rows[1:]))


def test_shared_folder_is_the_configured_one(spark):
    assert scratch.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")


def test_generic_rank_join_is_an_equi_join(tables):
    scored = tables.master().select("cve_id", risk.composite().alias(risk.SCORE))
    text = plan(dedup.dense_rank_by_value(scored, risk.SCORE, "r", most=10_004))
    assert "NestedLoop" not in text
