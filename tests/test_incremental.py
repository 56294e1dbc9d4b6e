"""Trends kept up from changes, sketches, ranks of many values, quoted newlines in splits."""

from __future__ import annotations

import csv
import gzip
import io
import os
import random

import pytest
from pyspark.sql import Window, functions as F

from cveflow import feeds, scratch
from cveflow.operators import dedup
from cveflow.plans import readiness, sketches, trend_state, trends
from cveflow.sources import quoted_csv


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_trends_kept_up_over_two_runs_equal_a_rebuild(tables):
    now = tables.master()
    part = F.pmod(F.xxhash64("cve_id"), F.lit(10))
    one = now.where(part < 6).withColumns({
        "published_ts": F.when(part < 2, F.col("published_ts") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("published_ts")),
        "primary_cwe": F.when(part == 3, "CWE-1").otherwise(F.col("primary_cwe")), "has_msf_module": part == 4})
    two = now.where(part < 8).withColumns({
        "cvss_v31_severity": F.when(part == 5, F.lit(None)).otherwise(F.col("cvss_v31_severity")),
        "epss_score": F.when(part != 7, F.col("epss_score")), "published_ts": F.when(part != 6, F.col("published_ts"))})
    days, counts, last = trend_state.state(one), trend_state.weaknesses(one), one
    for run in (two, now):
        gone = trend_state.replaced(last, run)
        days, counts, last = trend_state.advance(days, gone, run), trend_state.advance_weaknesses(counts, gone, run), run
        same(trend_state.daily(days), trends.daily(run))
        same(trend_state.weekly(days, counts), trends.weekly(run))
        same(trend_state.monthly(days), trends.monthly(run))
        same(trend_state.combined(days, as_of="2001-08-02"), trends.combined(run, as_of="2001-08-02"))
    same(trend_state.state(now), days)


def test_trends_of_nothing(tables):
    none = tables.master().limit(0)
    assert trend_state.advance(trend_state.state(none), none, none).count() == 0
    full = tables.master()
    assert trend_state.advance(trend_state.state(full), full, none).count() == 0


def test_sketches_of_two_runs_are_within_their_error(spark):
    rows = spark.range(60_000).select(
        F.expr("timestamp'2024-01-01' + make_interval(0, cast(id % 3 as int))").alias("published_ts"),
        F.concat(F.lit("p"), (F.col("id") % 9_000).cast("string")).alias("product"), ((F.col("id") * 7919) % 1000).alias("days"))
    first, second = rows.where("id % 4 < 3"), rows.where("id % 4 >= 2")  # a quarter comes twice
    parts = [sketches.by_month(r, distinct="product", number=F.col("days")) for r in (first, second)]
    got = {r.month_start: r for r in sketches.estimates(sketches.merged(parts[0].unionByName(parts[1]), "month_start")).collect()}
    want = rows.groupBy(F.date_trunc("month", "published_ts").cast("date").alias("m")).agg(F.count_distinct("product").alias("n")).collect()
    assert len(got) == len(want) == 3
    for w in want:
        r = got[w.m]
        assert abs(r.distinct_count - w.n) <= 5 * 0.0163 * w.n
        assert all(abs(v - 1000 * q) <= 1000 * 0.04 for v, q in ((r.q25, 0.25), (r.q50, 0.5), (r.q90, 0.9)))
    whole = sketches.estimates(sketches.merged(parts[0].unionByName(parts[1]))).first()
    assert abs(whole.distinct_count - 9000) <= 5 * 0.0163 * 9000


def test_sketches_of_the_master(tables):
    master = tables.master()
    days = readiness.days_to_exploit()
    got = sketches.estimates(sketches.by_month(master, distinct="primary_cwe", number=days))
    exact = master.groupBy(F.date_trunc("month", F.to_date("published_ts")).cast("date").alias("month_start")).agg(
        F.count_distinct("primary_cwe").alias("n"), F.count(days).alias("timed"))
    for r in got.join(exact, got.month_start.eqNullSafe(exact.month_start)).collect():
        assert abs(r.distinct_count - r.n) <= max(1, 0.1 * r.n) and (r.q50 is None) == (r.timed == 0)


def test_ranks_of_a_million_values_equal_dense_rank(spark):
    df = spark.range(0, 1_200_000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        (F.col("id") * 7919) % 1_000_003 + 10).alias("x"))
    for desc in (True, False):
        ranked = dedup.dense_rank_of_any(df, "x", "r", desc=desc)
        order = F.col("x").desc_nulls_last() if desc else F.col("x").asc_nulls_first()
        plain = df.select("x").distinct().withColumn("want", F.dense_rank().over(Window.orderBy(order)))
        assert ranked.count() == 1_200_000
        assert ranked.join(plain, ranked.x.eqNullSafe(plain.x)).where("r <> want or r is null").isEmpty()
    assert dedup.dense_rank_of_any(df.limit(0), "x", "r").count() == 0


def test_no_single_task_sorts_the_values(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 97)
    plan = dedup.dense_rank_of_any(df, "x", "r")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


NAMES = ["id", "file", "description", "date_published", "author", "platform", "type", "port", "codes"]


def quoted_file(rng, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    writer.writerow(NAMES)
    for n in range(rows):
        text = "".join(rng.choice(['a', 'b ', '"', '\n', ',', '\n\n', "é"]) for _ in range(rng.randrange(30)))
        writer.writerow([n, f"f{n}", text, "2024-01-01", rng.choice(["x", 'y "z"', "a\nb"]), "linux", "remote", "", f"CVE-2024-{n:04d}"])
        if rng.random() < 0.1:
            out.write("\n")
    return out.getvalue()


@pytest.mark.parametrize("split", [40, 333, 100_000])
def test_quoted_newlines_are_read_in_splits(spark, tmp_path, split):
    rng = random.Random(split)
    for n, rows in enumerate((200, 0, 57)):
        (tmp_path / f"f{n}.csv").write_text(quoted_file(rng, rows))
    plain = spark.read.csv(str(tmp_path), header=True, escape='"', multiLine=True, enforceSchema=False)
    want = sorted(map(tuple, plain.select(*NAMES).fillna("").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = feeds.read_exploits(spark, str(tmp_path), multiline=True)
        assert sorted(map(tuple, got.collect())) == want and len(want) == 257
        if split < 1000:
            assert spark.read.text(str(tmp_path / "f0.csv")).rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def shuffled_rows(df):
    """Rows written to shuffles by the plan of a frame that was collected."""
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(n) for n in range(node.children().size())]
    return total


def test_quoted_newlines_stay_where_they_are_read(spark, tmp_path):
    rows = [[str(n), f'say "{n}",\n\nthen {n}'] for n in range(3000)]
    with open(tmp_path / "a.csv", "w") as f:
        csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([["id", "text"], *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        read = quoted_csv.read(spark, str(tmp_path))
        assert sorted(map(list, read.collect())) == sorted(rows)
        assert shuffled_rows(read) < 300
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("batch", [1, 2, 7])
def test_quoted_records_that_span_batches(spark, tmp_path, batch):
    rng, want = random.Random(batch), []
    for name in ("a", "b", "c"):
        records = ["".join(rng.choice(["x", ",", '"\n"', '""', '"\n\n\ny"']) for _ in range(rng.randrange(12))) for _ in range(60)]
        records += ['open "x', "", "y,z"] if name == "c" else []
        (tmp_path / f"{name}.csv").write_text("".join(r + "\n" for r in records))
        if name == "c":
            records[-3:] = ["\n".join(records[-3:])]
        want += [(f"{name}.csv", n, r) for n, r in enumerate(records)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = quoted_csv.records(spark, str(tmp_path)).collect()
    finally:
        for key in ("files.maxPartitionBytes", "files.openCostInBytes", "execution.arrow.maxRecordsPerBatch"):
            spark.conf.unset(f"spark.sql.{key}")
    assert sorted((r.file.rpartition("/")[2], r.number, r.value) for r in got) == want


def test_a_file_with_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,file\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("file,id\nx,1\n")
    with pytest.raises(Exception, match="other columns"):
        quoted_csv.read(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("split", [False, True])
def test_undated_score_files(spark, tmp_path, split):
    head = "#model_version:v1,score_date:{}T00:00:00+0000\ncve,epss,percentile\n"
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(head.format("2024-05-01") + "CVE-2024-0001,0.1,0.5\nCVE-2024-0002,,\n")
    (tmp_path / "b.csv").write_text(head.format("2024-05-02").replace("\n", "\r\n") + 'CVE-2024-0001,"0.2",0.6\r\n\r\n')
    (tmp_path / "c.csv").write_text("cve,epss,percentile\nCVE-2024-0003,0.3,0.7")
    (tmp_path / "d.csv").write_text("#score_date:none\ncve,epss,percentile\n")
    got = feeds.read_epss(spark, str(tmp_path), as_of="2024-06-01", split=split)
    assert got.columns == ["cve", "epss", "percentile", "date"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("CVE-2024-0001", "0.1", "0.5", "2024-05-01"), ("CVE-2024-0001", "0.2", "0.6", "2024-05-02"),
        ("CVE-2024-0002", None, None, "2024-05-01"), ("CVE-2024-0003", "0.3", "0.7", "2024-06-01")]
    if not split:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
        (tmp_path / "e.csv").write_text("cve,percentile,epss\nCVE-2024-0003,0.3,0.7")
        with pytest.raises(Exception, match="not the columns"):
            feeds.read_epss(spark, str(tmp_path)).collect()


def test_old_intermediate_tables_are_swept(spark):
    kept = scratch.stored(spark.range(3), "kept")
    other, old = f"{scratch.shared_dir(spark)}/not-one-of-ours", scratch.fresh_path(spark, "old")
    for path in (other, old):
        spark.range(2).write.mode("overwrite").parquet(path)
        os.utime(path.removeprefix("file:"), (1, 1))
    assert scratch.sweep(spark, hours=1) == 1
    assert kept.count() == 3 and spark.read.parquet(other).count() == 2 and not os.path.exists(old.removeprefix("file:"))
