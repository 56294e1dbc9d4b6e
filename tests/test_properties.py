"""Laws that must hold on any data."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from cveflow.functions import values as v
from cveflow import clean, dedup, kpis, master, merge, readiness, risk, schema, testfeeds, trends, views

AS_OF = testfeeds.AS_OF


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


# --- newest row, ranks ---------------------------------------------------------------------------

def test_latest_does_not_depend_on_row_order(spark):
    rows = [(k, d, f"p{i}") for i, (k, d) in enumerate([(1, 5), (1, 5), (1, None), (2, None), (2, None), (3, 1)])]
    shape = "k int, d int, p string"
    a = dedup.latest_by(spark.createDataFrame(rows, shape), ["k"], ["d"])
    b = dedup.latest_by(spark.createDataFrame(rows[::-1], shape).repartition(3), ["k"], ["d"])
    assert same(a, b) and a.count() == 3
    assert {r.k: r.d for r in a.collect()} == {1: 5, 2: None, 3: 1}


@pytest.mark.parametrize("desc", [True, False])
@pytest.mark.parametrize("cast", ["double", "int"])
def test_dense_rank_equals_plain_window(spark, desc, cast):
    rows = [(i, None if i == 7 else 0.5 if i % 3 == 0 else i - 250.0 if i % 5 == 1 else (i * 37 % 101) / 100) for i in range(500)]
    if cast == "double":
        rows += [(900, float("nan")), (901, float("inf")), (902, float("-inf")), (903, -0.0), (904, 0.0)]
    df = spark.createDataFrame(rows, "id int, v double").select("id", F.col("v").try_cast(cast).alias("v"))
    order = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(order))).select("id", "r")
    ours = dedup.dense_rank_by_value(df, "v", "r", most=1000, desc=desc).select("id", "r")
    assert same(plain, ours)
    with pytest.raises(PySparkException, match="more than 10 values"):
        dedup.dense_rank_by_value(df, "v", "r", most=10, desc=desc).collect()


def test_a_third_of_all_rows_on_one_score(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") % 9000 / 10_000).alias("v"))
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last()))).select("id", "r")
    assert same(plain, dedup.dense_rank_by_value(df, "v", "r", most=10_004).select("id", "r"))


def test_average_is_rounded_once(spark):
    df = spark.createDataFrame([(2.3449999996,), (2.3449999996,)], "x double")
    assert df.agg(v.mean(F.col("x"), 2)).first()[0] == 2.34
    assert spark.createDataFrame([(2.34,), (2.35,)], "x double").agg(v.mean(F.col("x"), 2)).first()[0] == 2.35


def risky(spark, rows):
    shape = ("cve_id string, cvss_v31_base_score double, epss_score double, in_cisa_kev boolean, "
             "has_public_exploit boolean, has_msf_module boolean, is_ransomware_related boolean")
    df = spark.createDataFrame(rows, shape)
    fill = {"description_en": "string", "cvss_v31_severity": "string", "epss_percentile": "double",
            "exploit_count": "long", "msf_module_count": "long", "published_ts": "timestamp",
            "days_since_published": "int", "primary_cwe": "string", "vendor_project": "string", "product": "string"}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in fill.items()})


def test_score_formula_and_tiers(spark):
    out = {r.cve_id: r for r in risk.score(risky(spark, [
        ("all", 10.0, 1.0, True, True, True, True), ("none", 0.0, 0.0, False, False, False, False),
        ("half", 8.0, 0.24, True, False, False, False), ("kev", 0.0, 0.2, True, False, False, False),
    ]), as_of=AS_OF).collect()}
    assert [out[k].composite_risk_score for k in ("all", "half", "kev", "none")] == [1.0, 0.5, 0.25, 0.0]
    assert [out[k].risk_tier for k in ("all", "half", "kev", "none")] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert [out[k].priority_rank for k in ("all", "half", "kev", "none")] == [1, 2, 3, 4]


@pytest.mark.parametrize("weights", [risk.WEIGHTS, {**risk.WEIGHTS, "cvss": 3.0}, {**risk.WEIGHTS, "kev": -0.5}])
def test_no_row_is_lost_or_misranked_with_values_out_of_range(spark, weights):
    rows = [(f"c{i}", (i % 11) * 1.0, (i % 7) / 7, i % 2 == 0, i % 3 == 0, i % 5 == 0, False) for i in range(200)]
    rows += [("hi", 99.0, 0.5, True, True, True, True), ("hi2", 45.0, 0.5, True, False, False, False),
             ("lo", -80.0, 0.1, False, False, False, False), ("in", 11.0, 0.0, False, False, False, False),
             ("nan", math.nan, 0.1, False, False, False, False), ("null", None, 0.1, False, False, False, False)]
    df = risky(spark, rows)
    out = risk.score(df, as_of=AS_OF, weights=weights)
    plain = out.withColumn("want", F.dense_rank().over(Window.orderBy(F.col("composite_risk_score").desc_nulls_last())))
    assert out.count() == len(rows)
    assert plain.where(~F.col("want").eqNullSafe(F.col("priority_rank"))).isEmpty()


# --- master --------------------------------------------------------------------------------------

def test_master_has_one_row_per_clean_advisory(tables):
    built = tables.master()
    assert built.count() == tables.nvd().count() == built.select("cve_id").distinct().count()


def test_latest_epss_from_rows_equals_from_daily_table(tables):
    rows = clean.epss_rows(tables.raw("epss"))
    assert same(master.latest_epss(rows, tiebreak=testfeeds.TIEBREAK),
                master.latest_epss(tables.epss(), tiebreak=testfeeds.TIEBREAK))


def exploits(spark, rows):
    shape = ("exploit_id string, description string, date_published_dt date, author string, platform_clean string, "
             "exploit_type string, port_num int, cve_ids array<string>")
    return spark.createDataFrame(rows, shape)


def test_repeated_id_in_one_record_counts_twice_but_is_listed_once(spark):
    df = exploits(spark, [("1", "d", dt.date(2024, 1, 2), "a", "linux", "local", 1, ["CVE-2024-1", "CVE-2024-1"]),
                          ("2", "d", dt.date(2024, 1, 1), "a", "unix", "local", 1, ["CVE-2024-1"]),
                          ("3", "d", None, "a", "unix", "local", 1, []), ("4", "d", None, "a", "unix", "local", 1, None)])
    row = master.exploit_rollup(df).collect()
    assert len(row) == 1 and tuple(row[0]) == (
        "CVE-2024-1", 3, ["linux", "unix"], ["local"], dt.date(2024, 1, 1))
    assert sorted(map(tuple, master.exploit_ids(df).collect())) == [("CVE-2024-1", "1"), ("CVE-2024-1", "2")]


def test_hot_advisory_keeps_exact_counts_and_all_links(spark):
    rows = [(str(i), "d", None, "a", "linux", "local", 1, ["HOT"] + ([f"C{i % 10}"] if i % 2 else [])) for i in range(300)]
    df = exploits(spark, rows)
    out = {r.cve_id: r for r in master.exploit_rollup(df).collect()}
    assert out["HOT"].exploit_count == 300 and out["HOT"].exploit_platforms == ["linux"]
    ids = [r.exploit_id for r in master.exploit_ids(df).where("cve_id = 'HOT'").collect()]
    assert sorted(ids, key=int) == [str(i) for i in range(300)]


@pytest.mark.parametrize("feed", ["nvd", "kev", "epss", "exploits", "modules"])
def test_update_with_new_rows_equals_a_rebuild(tables, feed):
    ties = testfeeds.TIEBREAK
    rows, build = tables.raw(feed), getattr(clean, feed)
    old, new = rows.where("_ingested_at < '2001-08-02'"), rows.where("_ingested_at >= '2001-08-02'")
    whole = build(rows, tiebreak=ties)
    assert same(clean.update(feed, build(old, tiebreak=ties), new, tiebreak=ties), whole)
    assert same(clean.update(feed, whole, rows, tiebreak=ties), whole)


def test_marts_have_the_declared_schema(tables):
    def types(fields):
        return [(f.name, f.dataType.simpleString()) for f in fields]

    for declared, mart in ((schema.MASTER, tables.master()), (schema.RISK, tables.risk()),
                           (schema.TRENDS, tables.trends()), (schema.READINESS, tables.readiness())):
        assert types(mart.schema) == types(declared)
    assert risk.score(tables.master()).columns == list(risk.COLUMNS)


# --- upsert --------------------------------------------------------------------------------------

def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, day int")
    source = spark.createDataFrame([(2, "B", 2), (3, "C", 2)], "k int, v string, day int")
    once = merge.upsert(target, source, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1), (2, "B", 2), (3, "C", 2)]
    assert same(once, merge.upsert(once, source, ["k"]))
    assert same(merge.upsert(None, source, ["k"]), source)


def test_upsert_refuses_duplicate_source_keys_unless_ordered(spark):
    target = spark.createDataFrame([(1, "a", 1)], "k int, v string, day int")
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (2, "z", 0), (3, "w", 1)], "k int, v string, day int")
    with pytest.raises(PySparkException, match="duplicate source key"):
        merge.upsert(target, source, ["k"]).collect()
    ordered = merge.upsert(target, source, ["k"], order_cols=["day"])
    assert sorted(map(tuple, ordered.collect())) == [(1, "a", 1), (2, "y", 2), (3, "w", 1)]


# --- marts ---------------------------------------------------------------------------------------

def test_narrow_trends_are_the_common_columns_of_the_wide_ones(tables):
    wide = tables.master()
    narrow = trends.combined(wide, as_of=AS_OF)
    for kind, frame, start in (("daily", trends.daily(wide), "publish_date"),
                               ("weekly", trends.weekly(wide), "week_start"),
                               ("monthly", trends.monthly(wide), "month_start")):
        common = [F.round(c, 9).alias(c) if c.startswith("avg") else F.col(c) for c in trends.COMMON]
        a = frame.select(F.col(start).cast("string").alias("period"), *common)
        b = narrow.where(F.col("trend_type") == kind).select("period", *common)
        assert same(a, b)


def test_readiness_levels_add_up_to_the_overview(tables):
    counts = {r.weaponization_level: r.cve_count for r in kpis.weaponization(tables.readiness()).collect()}
    seen = readiness.overview(tables.master()).first()
    get = lambda n: counts.get(n, 0)
    assert get("FULL") == seen.exploit_and_module
    assert get("FULL") + get("EXPLOIT_ONLY") == seen.with_public_exploit
    assert get("FULL") + get("MODULE_ONLY") == seen.with_msf_module
    assert sum(counts.values()) == seen.total_cves


def test_rows_without_a_level_stay_in_the_denominator(spark):
    df = spark.createDataFrame([("a", "FULL"), ("b", None), ("c", None), ("d", None)], "cve_id string, weaponization_level string")
    df = df.withColumns({"cvss_v31_base_score": F.lit(1.0), "epss_score": F.lit(0.5), "in_cisa_kev": F.lit(True)})
    rows = kpis.weaponization(df).collect()
    assert [(r.weaponization_level, r.cve_count, r.pct_of_total) for r in rows] == [("FULL", 1, 25.0)]


def test_time_to_exploit_boundaries(spark):
    days = [-1, 0, 1, 7, 8, 30, 31, 90, 91, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d int")
    out = df.orderBy("i").select(readiness.t2e_category(F.when(F.col("d") >= 0, F.col("d")))).collect()
    assert [r[0] for r in out] == [None, "SAME_DAY", "WITHIN_7D", "WITHIN_7D", "WITHIN_30D", "WITHIN_30D", "WITHIN_90D",
                                   "WITHIN_90D", "OVER_90D", None]


def test_approximate_percentiles_are_near_the_exact_ones(tables):
    exact = readiness.tte_stats(tables.master(), exact=True).first().asDict()
    near = readiness.tte_stats(tables.master()).first().asDict()
    spread = exact["max_days_to_exploit"] - exact["min_days_to_exploit"]
    assert exact.keys() == near.keys()
    assert all(abs(exact[k] - near[k]) <= max(2, spread * 0.01) for k in exact)


def test_snapshot_of_empty_tables(spark, tables):
    empty = kpis.to_long(kpis.snapshot(tables.master().limit(0), tables.risk().limit(0), as_of=AS_OF), as_of=AS_OF)
    values = {r.kpi_name: r.kpi_value for r in empty.collect()}
    assert len(values) == len(kpis.KPIS) == 20 and set(values.values()) == {0.0}


def test_snapshot_counts_only_the_risk_rows_of_its_run(tables):
    other = kpis.snapshot(tables.master(), tables.risk(), as_of="2001-07-20").first()
    assert other.critical_risk_count + other.high_risk_count + other.medium_risk_count + other.low_risk_count == 0
    own = kpis.snapshot(tables.master(), tables.risk(), as_of=AS_OF).first()
    assert own.critical_risk_count + own.high_risk_count + own.medium_risk_count + own.low_risk_count == own.total_active_cves


def test_views_answer_sql(spark, tables):
    names = views.register_views(spark, {
        "master": tables.master(), "risk": tables.risk(), "trends": tables.trends(),
        "readiness": tables.readiness(), "kpis": tables.kpi_history()}, as_of=AS_OF)
    assert len(names) == 8
    for name in names:
        assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] >= 0
    top = spark.sql("SELECT composite_risk_score FROM vw_top_risks").collect()
    assert 0 < len(top) <= 100 and all(r[0] > 0.5 for r in top)


def test_kpi_history_schema(tables):
    long = kpis.to_long(kpis.snapshot(tables.master(), tables.risk(), as_of=AS_OF), as_of=AS_OF)
    assert [(f.name, f.dataType) for f in long.schema] == [(f.name, f.dataType) for f in schema.KPI_HISTORY]
