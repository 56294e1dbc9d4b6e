"""Whole daily runs, incremental pickup and the sinks."""

import pytest
from pyspark.sql import functions as F

from cveflow import daily, ingest, schema, sinks, testfeeds, views


def raw_tables(tables):
    return {feed: tables.raw(feed) for feed in testfeeds.STATEMENTS}


def test_two_runs(spark, tables, tmp_path):
    raw, root = raw_tables(tables), str(tmp_path / "out")
    early = {**raw, "nvd": raw["nvd"].where("published < '2000-01-01'")}
    first = daily.run(spark, early, root, as_of="2001-08-01", tiebreak=testfeeds.TIEBREAK)
    late = {**raw, "nvd": raw["nvd"].where("published >= '1999-01-01'")}
    second = daily.run(spark, late, root, as_of="2001-08-02", tiebreak=testfeeds.TIEBREAK,
                       previous=f"{root}/run=2001-08-01")
    wide, total = spark.read.parquet(second["master"]), tables.nvd().count()
    assert wide.count() == total == wide.select("cve_id").distinct().count()
    days = {r.day: r.n for r in wide.groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert days == {2: total}  # cleaned tables are carried forward, so every advisory is built anew
    risk = spark.read.parquet(second["risk"])  # the whole master is scored anew in every run
    assert risk.count() == risk.where("day = 2").count() == total
    assert spark.read.parquet(first["master"]).where("published_ts >= '2000-01-01'").isEmpty()
    history = spark.read.schema(schema.KPI_HISTORY).parquet(second["kpis"])
    assert history.count() == 40 and views.latest_kpis(history).count() == 20


def test_two_runs_by_table_name(spark, tables):
    raw = raw_tables(tables)
    early = {**raw, "nvd": raw["nvd"].where("published < '2000-01-01'")}
    late = {**raw, "nvd": raw["nvd"].where("published >= '1999-01-01'")}
    spark.sql("DROP DATABASE IF EXISTS daily_runs CASCADE")
    first = daily.run_tables(spark, early, "daily_runs", as_of="2001-08-01", tiebreak=testfeeds.TIEBREAK)
    part = spark.table("daily_runs.master").count()
    second = daily.run_tables(spark, late, "daily_runs", as_of="2001-08-02", tiebreak=testfeeds.TIEBREAK)
    total = tables.nvd().count()
    assert first == second and part < total == spark.table("daily_runs.master").select("cve_id").distinct().count()
    assert spark.table("daily_runs.kpis").count() == 40
    links = spark.table("daily_runs.exploit_ids").groupBy("cve_id").count().count()
    assert links >= spark.table("daily_runs.master").where("has_public_exploit").count() > 0
    names = views.create_views(spark, "daily_runs", as_of="2001-08-02")
    frames = views.register_views(
        spark, {n: spark.table(f"daily_runs.{n}") for n in ("master", "risk", "trends", "readiness", "kpis")}, as_of="2001-08-02")
    for name, frame in zip(names, frames):
        stored, plain = spark.table(name), spark.table(frame)
        assert stored.columns == plain.columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect())), name
    spark.sql("DROP DATABASE daily_runs CASCADE")


def test_lost_checkpoint_fails(spark, tmp_path):
    write = ingest.to_table(str(tmp_path / "t"))
    batch = spark.createDataFrame([("a",)], "cve string")
    write(batch, 0), write(batch, 1)
    with pytest.raises(ValueError, match="checkpoint"):
        write(batch, 0)


def test_incremental_pickup_sees_only_new_files(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    shape = "cve string, epss string"
    seen = []
    write = ingest.to_table(table)

    def on_batch(batch, epoch):
        seen.append(batch.count())
        write(batch, epoch)

    def deliver(rows):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").json(inbox)
        ingest.ingest_incremental(spark, inbox, shape, on_batch, checkpoint=state).awaitTermination()

    deliver([("CVE-2024-0001", "0.1"), ("CVE-2024-0002", "0.2")])
    deliver([("CVE-2024-0003", "0.3")])
    assert seen == [2, 1]
    rows = ingest.read_table(spark, table, schema.strings(["cve", "epss"]))
    assert rows.count() == 3 and rows.columns == ["cve", "epss"]


def test_repeated_batch_does_not_duplicate(spark, tmp_path):
    write = ingest.to_table(str(tmp_path / "t"))
    batch = spark.createDataFrame([("a",)], "cve string")
    write(batch, 0), write(batch, 0), write(batch, 1)
    assert ingest.read_table(spark, str(tmp_path / "t"), schema.strings(["cve"])).count() == 2


def test_append_adds_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, 2024, 1, 1)], "v int, year int, month int, day int")
    two = spark.createDataFrame([("x", 2024, 1, 2)], "w string, year int, month int, day int")
    assert sinks.append(one, path).get["rows"] == 1
    sinks.append(one, path)
    assert spark.read.parquet(path).count() == 2
    assert sinks.overwrite(two, path, rebalance=True).get["rows"] == 1
    back = spark.read.parquet(path)
    assert back.columns == ["w", "year", "month", "day"] and back.count() == 1


def test_rebalance_writes_few_files_per_partition(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).select("id", F.lit(2024).alias("year"), F.lit(1).alias("month"),
                                            (F.col("id") % 20).cast("int").alias("day"))
    path = str(tmp_path / "t")
    sinks.overwrite(df, path, rebalance=True)
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files <= 40
