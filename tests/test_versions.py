"""Versioned tables: crashes at every step, changes only, compaction, keyed pickup."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from cveflow import daily, ingest, sinks, versions

SHAPE = "k string, x bigint, year int, month int, day int"
OLD = [("a", 1, 2024, 1, 1), ("b", 2, 2024, 1, 1), ("c", 3, 2024, 1, 2)]
CHANGE = [("b", 20, 2024, 1, 3), ("d", 4, 2024, 1, 3)]
NEW = sorted([OLD[0], OLD[2], *CHANGE])


class Killed(BaseException):
    pass


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "x", "year", "month", "day").collect())


def killed_at(monkeypatch, spark, n):
    """Let the ``n``-th step of a change fail."""
    calls = [0]

    def step(f):
        def run(*args, **kwargs):
            calls[0] += 1
            if calls[0] == n:
                raise Killed
            return f(*args, **kwargs)
        return run

    for where, name in ((versions, "_written"), (versions, "commit"), (versions, "delete"), (type(spark), "sql")):
        monkeypatch.setattr(where, name, step(getattr(where, name)))
    return calls


@pytest.fixture
def quick(spark):
    """Tables of a few rows need no more than one task."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("kind", ["folder", "name", "plain name"])
def test_a_merge_killed_at_any_step_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, quick, kind):
    old, change = spark.createDataFrame(OLD, SHAPE), spark.createDataFrame(CHANGE, SHAPE)
    spark.sql("CREATE DATABASE IF NOT EXISTS crashes")
    for n in range(1, 40):
        target = f"{tmp_path}/t{n}" if kind == "folder" else f"crashes.t{n}_{kind[0]}"
        if kind == "plain name":
            sinks.overwrite(old, target)
        else:
            sinks.publish(old, target)
        with monkeypatch.context() as m:
            calls = killed_at(m, spark, n)
            try:
                sinks.merge_table(change, target, ["k"])
                done = True
            except Killed:
                done = False
        if kind == "folder" or sinks.exists(spark, target):
            assert rows(sinks.read(spark, target)) in (sorted(OLD), NEW), (n, kind)
        else:
            raise AssertionError(f"{target} is gone at step {n}")
        sinks.merge_table(change, target, ["k"])
        assert rows(sinks.read(spark, target)) == NEW, (n, kind)
        if done:
            break
    assert done and calls[0] >= 2
    spark.sql("DROP DATABASE crashes CASCADE")


def test_a_replaced_table_killed_while_written_keeps_its_rows(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.publish(spark.createDataFrame(OLD, SHAPE), path)
    failing = spark.createDataFrame(CHANGE, SHAPE).withColumn("x", F.when(F.col("k") == "d", F.raise_error("no").cast("bigint")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="no"):
        sinks.publish(failing, path)
    assert rows(sinks.read(spark, path)) == sorted(OLD)
    sinks.publish(sinks.read(spark, path).where("k <> 'a'"), path)  # reads what it replaces
    assert rows(sinks.read(spark, path)) == sorted(OLD)[1:]


def test_a_cut_off_manifest_is_no_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.publish(spark.createDataFrame(OLD, SHAPE), path)
    with open(versions._manifest(path, 7), "w") as f:
        f.write('{"schema": {"type": "str')
    assert versions.current(spark, path).number == 1
    sinks.merge_table(spark.createDataFrame(CHANGE, SHAPE), path, ["k"])
    assert versions.current(spark, path).number == 8 and rows(sinks.read(spark, path)) == NEW


def test_of_two_writers_one_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.publish(spark.createDataFrame(OLD, SHAPE), path)
    now = versions.current(spark, path)
    with pytest.raises(Exception, match="exists"):
        versions.commit(spark, path, now)


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/_versions/data/*/**/*.parquet", recursive=True)}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    wide = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), "id", (F.col("id") % 50).cast("int").alias("day"), F.lit("v").alias("w"))
    assert versions.publish(wide, path, partition_by=["day"]) == 5000
    before = files(path)
    source = wide.where("id in (3, 53, 4)").withColumn("w", F.lit("changed")).unionByName(wide.where("id < 1000 and day not in (3, 4)"))
    assert versions.merge(source, path, ["k"]) == 200  # two partitions of 100 rows
    new = {f for f in files(path) if f not in before}
    assert {f.rsplit("/", 2)[1] for f in new} == {"day=3", "day=4"} and all(files(path)[f] == t for f, t in before.items())
    back = versions.read(spark, path)
    assert back.count() == 5000 and {r.id for r in back.where("w = 'changed'").collect()} == {3, 53, 4}
    # a row that moves takes its old partition along
    assert versions.merge(wide.where("id = 7").withColumn("day", F.lit(8)), path, ["k"]) == 99 + 101
    assert versions.read(spark, path).where("k = 'k7'").collect()[0].day == 8
    # a difference in an ignored column is none
    assert versions.merge(wide.withColumn("w", F.lit("z")), path, ["k"], ignore=["w", "day"]) == 0
    versions.vacuum(spark, path, keep=1)
    assert versions.read(spark, path).count() == 5000 and not set(before) <= set(files(path))


def test_odd_sources(spark, tmp_path):
    path = f"{tmp_path}/odd name"
    shape = "k string, v string, p string"
    start = [("a", None, "x/y"), ("b", "1", None), (None, "2", "x/y"), ("c", "é", "=%")]
    versions.publish(spark.createDataFrame(start, shape), path, partition_by=["p"])
    assert sorted(versions.read(spark, path).collect(), key=str) == sorted(map(tuple, start), key=str)
    with pytest.raises(Exception, match="duplicate source key"):
        versions.merge(spark.createDataFrame([("z", "1", "q"), ("z", "2", "q")], shape), path, ["k"])
    assert versions.merge(spark.createDataFrame([], shape), path, ["k"]) == 0
    # null keys match nothing; an unchanged row, nulls included, is no change
    assert versions.merge(spark.createDataFrame([("a", None, "x/y"), ("b", "1", None)], shape), path, ["k"]) == 0
    versions.merge(spark.createDataFrame([(None, "3", "=%"), ("b", None, None)], shape), path, ["k"])
    want = [("a", None, "x/y"), ("b", None, None), (None, "2", "x/y"), (None, "3", "=%"), ("c", "é", "=%")]
    assert sorted(map(tuple, versions.read(spark, path).collect()), key=str) == sorted(want, key=str)
    empty = f"{tmp_path}/empty"
    assert versions.publish(spark.createDataFrame([], shape), empty, partition_by=["p"]) == 0
    assert versions.read(spark, empty).count() == 0 and versions.merge(spark.createDataFrame(start[:2], shape), empty, ["k"]) == 2


def test_small_files_are_packed(spark, tmp_path):
    path, target = f"{tmp_path}/t", 150_000
    df = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("s"), (F.col("id") % 2).cast("int").alias("day"))
    for n in range(6):
        df.where(F.pmod(F.xxhash64("s"), F.lit(6)) == n).repartition(3).write.mode("append").partitionBy("day").parquet(path)
    big = spark.range(4000).select(F.sha2((F.col("id") + 10**6).cast("string"), 256).alias("s"), F.lit(5).alias("day")).coalesce(1)
    big.write.mode("append").partitionBy("day").parquet(path)
    plain = spark.read.parquet(path)
    want = sorted(map(tuple, plain.select("s", "day").collect()))
    assert sinks.compact(spark, path, size=target, partition_by=["day"]) > 0
    sizes = {}
    for f in files(path):
        sizes.setdefault(f.rsplit("/", 2)[1], []).append(os.path.getsize(f))
    assert sorted(map(tuple, sinks.read(spark, path).select("s", "day").collect())) == want
    # the partition with one file stays where it is; the others have few files, none far over the target
    assert set(sizes) == {"day=0", "day=1"} and all(len(s) <= 2 and max(s) <= 1.2 * target for s in sizes.values()), sizes
    assert sinks.compact(spark, path, size=target) == 0 or max(map(len, sizes.values())) > 1


def test_bins_hold_at_most_the_target():
    import pandas as pd

    sizes = [5, 60, 50, 40, 30, 100, 250, 1]
    packed = versions._bins(100)(pd.DataFrame({"path": list("abcdefgh"), "length": sizes}))
    held = packed.groupby("bin")["length"].agg(["sum", "count"])
    assert all(s <= 100 or n == 1 for s, n in held.itertuples(index=False)) and held["sum"].sum() == sum(sizes)
    assert len(held) == 4 and sorted(packed["bin"].unique()) == list(range(4))


def test_a_lost_checkpoint_replays_without_doubling(spark, tmp_path):
    inbox, table = f"{tmp_path}/in", f"{tmp_path}/t"
    shape = "cve string, at int, epss string"
    write = ingest.to_keyed(table, ["cve"], ["at"], buckets=4)
    seen = []

    def on_batch(batch, epoch):
        seen.append(batch.count())
        write(batch, epoch)

    def deliver(new, state):
        if new:
            spark.createDataFrame(new, shape).coalesce(1).write.mode("append").json(inbox)
        ingest.ingest_incremental(spark, inbox, shape, on_batch, checkpoint=f"{tmp_path}/{state}", file="_file").awaitTermination()

    deliver([("A", 2, "0.1"), ("B", 1, "0.2"), ("A", 1, "0.0")], "one")
    deliver([("B", 3, "0.3"), ("A", 1, "9.9"), ("C", 1, "0.4")], "one")
    want = [("A", 2, "0.1"), ("B", 3, "0.3"), ("C", 1, "0.4")]
    get = lambda: sorted(map(tuple, ingest.read_keyed(spark, table).select("cve", "at", "epss").collect()))
    assert get() == want
    version = versions.current(spark, table).number
    deliver([], "two")
    assert seen == [3, 3, 6] and get() == want and versions.current(spark, table).number == version
    deliver([("A", 5, "0.5")], "two")
    assert get() == [("A", 5, "0.5"), *want[1:]]
    assert versions.taken_in(spark, versions.current(spark, table)).count() == 3


def test_a_batch_killed_before_its_commit_is_taken_again(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/t"
    write = ingest.to_keyed(table, ["k"], ["v"], buckets=2)
    batch = spark.createDataFrame([("a", 1, "f1"), ("b", 2, "f2")], "k string, v int, _file string")
    for name in ("_written", "commit"):
        with monkeypatch.context() as m:
            m.setattr(versions, name, lambda *a, **k: (_ for _ in ()).throw(Killed()))
            with pytest.raises(Killed):
                write(batch, 0)
        assert versions.current(spark, table) is None
    write(batch, 0), write(batch, 0), write(batch, 7)
    assert sorted(map(tuple, ingest.read_keyed(spark, table).select("k", "v").collect())) == [("a", 1), ("b", 2)]
    assert versions.current(spark, table).number == 2


def test_daily_tables_survive_a_killed_run(spark, tables, monkeypatch):
    from cveflow import testfeeds

    raw = {feed: tables.raw(feed) for feed in testfeeds.STATEMENTS}
    spark.sql("DROP DATABASE IF EXISTS killed_runs CASCADE")
    daily.run_tables(spark, raw, "killed_runs", as_of="2001-08-01", tiebreak=testfeeds.TIEBREAK)
    total = spark.table("killed_runs.master").count()
    none = {feed: df.limit(0) for feed, df in raw.items()}
    for n in (2, 9):
        with monkeypatch.context() as m:
            killed_at(m, spark, n)
            with pytest.raises(Killed):
                daily.run_tables(spark, none, "killed_runs", as_of="2001-08-02", tiebreak=testfeeds.TIEBREAK)
        assert spark.table("killed_runs.master").count() == total and spark.table("killed_runs.nvd").count() == tables.nvd().count()
    spark.sql("DROP DATABASE killed_runs CASCADE")
