"""Tables as versioned folders: every change writes new folders beside the old ones, then one small file makes them current.

``<table>/_versions/data/<n>`` holds what change ``n`` wrote, partition folders as Spark writes them, and
``<table>/_versions/manifests/<n>.json`` names the partition folders that make up version ``n``.  The current version is that of the newest
manifest that is complete.  A run killed before its manifest is there leaves the version of before; nothing is ever overwritten, and a
number is never used twice.  A manifest is created exclusively, so of two writers that started from the same version the second fails.

Every partition of a version lies in one folder.  A change takes over the folders it doesn't touch, so what it writes follows what it changes.
Old versions are kept until ``vacuum``.  Needs a classic session (the Hadoop file system of the JVM), not Spark Connect.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from cveflow.operators.merge import unique_keys
from cveflow.scratch import stored

HOME = "_versions"
#: Bytes of a file that compaction aims at; files of less than three quarters of it count as small.
TARGET = 128 << 20
#: Files that are packed into bins together.
PACKED = 10_000


@dataclass(frozen=True)
class Version:
    """``parts``: folder of a change to those of its partition folders that are live; ``ledger``: folders with the files taken in so far."""

    number: int
    schema: StructType
    partition_by: tuple[str, ...]
    parts: dict[str, tuple[str, ...]]
    ledger: tuple[str, ...] = field(default=())

    def folders(self) -> list[str]:
        return [_join(base, rel) for base, rels in self.parts.items() for rel in rels]


def _join(base: str, rel: str) -> str:
    return f"{base}/{rel}" if rel else base


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names in a folder and whether they are folders; nothing if it isn't there."""
    fs, at = _fs(spark, path)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    names = (n.removesuffix(".json") for n, _ in _listed(spark, f"{path}/{HOME}/{kind}"))
    return sorted(int(n) for n in names if n.isdigit())


def _manifest(path: str, number: int) -> str:
    return f"{path}/{HOME}/manifests/{number:09d}.json"


def _load(spark: SparkSession, path: str, number: int) -> Version | None:
    """The version, or None if its manifest was cut off."""
    fs, at = _fs(spark, _manifest(path, number))
    size = fs.getFileStatus(at).getLen()
    stream = fs.open(at)
    try:
        text = bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()
    try:
        m = json.loads(text)
    except json.JSONDecodeError:
        return None
    return Version(
        number, StructType.fromJson(m["schema"]), tuple(m["partition_by"]), {b: tuple(r) for b, r in m["parts"].items()}, tuple(m["ledger"]))


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest complete version of a table."""
    for number in reversed(_numbers(spark, path, "manifests")):
        found = _load(spark, path, number)
        if found:
            return found
    return None


def _nullable(schema: StructType) -> StructType:
    """The schema as files have it: everything may be null."""
    text = schema.json()
    for name in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{name}":false', f'"{name}":true')
    return StructType.fromJson(json.loads(text))


def _next(spark: SparkSession, path: str) -> int:
    return max([0, *_numbers(spark, path, "manifests"), *_numbers(spark, path, "data")]) + 1


def commit(spark: SparkSession, path: str, version: Version) -> Version:
    """Make a version current.  Fails if its number is taken."""
    text = json.dumps({
        "schema": version.schema.jsonValue(), "partition_by": version.partition_by, "parts": version.parts, "ledger": version.ledger})
    fs, at = _fs(spark, _manifest(path, version.number))
    stream = fs.create(at, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return version


def _read(spark: SparkSession, version: Version, parts: dict[str, Sequence[str]], file: str | None = None) -> DataFrame:
    names: list = [F.col(f"`{c}`") for c in version.schema.names]
    if file:
        names.append(F.col("_metadata.file_path").alias(file))
    found = [
        spark.read.schema(version.schema).option("basePath", base).parquet(*[_join(base, r) for r in rels]).select(*names)
        for base, rels in parts.items() if rels]
    if found:
        return reduce(DataFrame.unionAll, found)
    empty = spark.createDataFrame([], version.schema)
    return empty.withColumn(file, F.lit(None).cast("string")) if file else empty


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version."""
    version = current(spark, path)
    if version is None:
        raise ValueError(f"{path} has no version")
    return _read(spark, version, version.parts)


def _leaves(spark: SparkSession, base: str, depth: int, rel: str = "") -> Iterator[str]:
    """Partition folders under ``base``."""
    if depth == 0:
        yield rel
        return
    for name, folder in _listed(spark, _join(base, rel)):
        if folder and "=" in name:
            yield from _leaves(spark, base, depth - 1, f"{rel}/{name}" if rel else name)


def _written(df: DataFrame, path: str, number: int, partition_by: Sequence[str]) -> tuple[str, tuple[str, ...], int]:
    """Write the rows of change ``number``; its folder, partition folders and number of rows."""
    base = f"{path}/{HOME}/data/{number}"
    seen = Observation(f"written-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by).parquet(base)
    return base, tuple(_leaves(df.sparkSession, base, len(partition_by))), seen.get["rows"]


def _laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: str | None) -> DataFrame:
    """Rows of a partition together, in ranges of ``cluster_by`` if there is one."""
    if cluster_by is None:
        return df.hint("rebalance", *partition_by) if partition_by else df
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartitionByRange(*map(F.col, partition_by), F.col(cluster_by), spread).sortWithinPartitions(*partition_by, cluster_by)


def publish(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), cluster_by: str | None = None) -> int:
    """Replace all rows of a table, or create it; the number of rows written.  ``df`` may read the table."""
    spark = df.sparkSession
    number, before = _next(spark, path), current(spark, path)
    base, parts, rows = _written(_laid_out(df, partition_by, cluster_by), path, number, partition_by)
    commit(spark, path, Version(number, _nullable(df.schema), tuple(partition_by), {base: parts}, before.ledger if before else ()))
    return rows


def _digests(columns: Sequence[str]) -> list[Column]:
    """128 bits that stand for the values of a row."""
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(7), *values).alias("_one"), F.xxhash64(F.lit(11), *reversed(values)).alias("_two")]


def _spelled(spark: SparkSession, partition_by: Sequence[str], values: Sequence[str | None]) -> str:
    """A partition's folder as Spark names it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    # Fixed value: the folder name of a missing partition value.
    return "/".join(f"{escape(c)}={escape(v) if v else '__HIVE_DEFAULT_PARTITION__'}" for c, v in zip(partition_by, values))


def changes(
    base: DataFrame, source: DataFrame, keys: Sequence[str], *, ignore: Sequence[str] = (), order_cols: Sequence[str] = (), at: str | None = None
) -> DataFrame:
    """The rows of ``source`` that are new or differ from those of ``base``; a repeated source key fails the job.

    Columns in ``ignore`` alone don't make a difference.  With ``order_cols``, rows older than those they would replace are left out.  With
    ``at``, a column of ``base``, the result has the set of its values for the key.  Null keys match nothing.
    """
    compared = [c for c in source.columns if c not in keys and c not in ignore]
    marked = source.select("*", *_digests(compared))
    order = F.struct(*[F.col(f"`{c}`") for c in order_cols]) if order_cols else F.lit(None)
    old = base.select(*keys, *_digests(compared), order.alias("_order"), (F.col(at) if at else F.lit(None)).alias("_at"))
    old = old.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.max("_one").alias("_old_one"), F.max("_two").alias("_old_two"),
        F.max("_order").alias("_order"), F.collect_set("_at").alias("_at"))
    unique = unique_keys(source, keys).withColumn("_once", F.lit(True))
    same = reduce(Column.__and__, [marked[k].eqNullSafe(unique[k]) for k in keys])
    checked = marked.join(unique, same, "left_semi")
    joined = checked.join(old, list(keys), "left")
    differs = F.col("_n").isNull() | (F.col("_n") > 1) | (F.col("_one") != F.col("_old_one")) | (F.col("_two") != F.col("_old_two"))
    if order_cols:
        differs = differs & (F.col("_n").isNull() | (order >= F.col("_order")))
    return joined.where(differs).select(*source.columns, *([F.coalesce("_at", F.array().cast("array<string>")).alias(at)] if at else []))


def merge(
    df: DataFrame, path: str, keys: Sequence[str], *, partition_by: Sequence[str] = (), cluster_by: str | None = None,
    ignore: Sequence[str] = (), order_cols: Sequence[str] = (), files: DataFrame | None = None,
) -> int:
    """Upsert ``df`` by key, or create the table; the number of rows written.

    Only partitions that hold a changed row before or after are written.  Rows that are equal to those they would replace
    (up to ``ignore``) change nothing.  ``files`` (one column, ``file``) go into the ledger with the same commit.
    """
    spark = df.sparkSession
    now = current(spark, path)
    number = _next(spark, path)
    ledger = now.ledger if now else ()
    if files is not None:
        taken = f"{path}/{HOME}/ledger/{number}"
        files.select("file").distinct().write.mode("overwrite").parquet(taken)
        ledger = (*ledger, taken)
    if now is None:
        unique = unique_keys(df, keys)
        checked = df.join(unique, reduce(Column.__and__, [df[k].eqNullSafe(unique[k]) for k in keys]), "left_semi")
        base, parts, rows = _written(_laid_out(checked, partition_by, cluster_by), path, number, partition_by)
        commit(spark, path, Version(number, _nullable(df.schema), tuple(partition_by), {base: parts}, ledger))
        return rows
    partition_by = now.partition_by
    source = df.to(now.schema)
    old = _read(spark, now, now.parts, file="_file").withColumn("_file", F.regexp_replace("_file", "/[^/]*$", ""))
    new = stored(changes(old, source, keys, ignore=ignore, order_cols=order_cols, at="_file"), "changes")
    folders = {r[0] for r in new.select(F.explode("_file")).distinct().collect()}
    values = [F.col(f"`{c}`").cast("string") for c in partition_by]
    spelled = {_spelled(spark, partition_by, r) for r in (new.select(*values).distinct().collect() if partition_by else [()])}
    if new.isEmpty():
        if files is not None:
            commit(spark, path, replace(now, number=number, ledger=ledger))
        return 0
    plain = {_plain(f) for f in folders}
    touched = {b: tuple(r for r in rels if r in spelled or _plain(_join(b, r)) in plain) for b, rels in now.parts.items()}
    kept = _read(spark, now, touched).join(new.select(*keys), list(keys), "left_anti")
    rows = kept.unionByName(new.drop("_file"))
    base, parts, count = _written(_laid_out(rows, partition_by, cluster_by), path, number, partition_by)
    left = {b: tuple(r for r in rels if r not in touched[b]) for b, rels in now.parts.items()}
    commit(spark, path, Version(number, now.schema, partition_by, {**{b: r for b, r in left.items() if r}, base: parts}, ledger))
    return count


def _plain(folder: str) -> str:
    """A folder without scheme and host, as readers and writers spell these differently."""
    from urllib.parse import unquote, urlsplit

    return unquote(urlsplit(folder).path if "://" in folder or folder.startswith("file:") else folder)


def taken_in(spark: SparkSession, version: Version | None) -> DataFrame:
    """The files in the ledger."""
    if version is None or not version.ledger:
        return spark.createDataFrame([], "file string")
    return spark.read.schema("file string").parquet(*version.ledger)


def adopt(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> Version:
    """Version 1 of a plain Parquet folder, whose files stay where they are.  From then on, use the functions of this module."""
    plain = spark.read.parquet(path)
    return commit(spark, path, Version(1, _nullable(plain.schema), tuple(partition_by), {path: tuple(_leaves(spark, path, len(partition_by)))}))


def _bins(target: int):
    def pack(files):
        """First fit, largest first: every bin holds at most ``target`` bytes, or one file."""
        files = files.sort_values(["length", "path"], ascending=[False, True])
        room: list[int] = []
        chosen = []
        for size in files["length"].tolist():
            k = next((k for k, left in enumerate(room) if left >= size), len(room))
            if k == len(room):
                room.append(target)
            room[k] -= size
            chosen.append(k)
        return files.assign(bin=chosen)
    return pack


def small_files(spark: SparkSession, version: Version, target: int = TARGET) -> DataFrame:
    """``path, length, folder`` of all files in partitions with two small files or more."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(version.folders()).select("path", "length")
    files = files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    many = files.groupBy("folder").agg(F.count_if(F.col("length") < 0.75 * target).alias("small")).where("small > 1")
    return files.join(many.select("folder"), "folder", "left_semi")


def compact(spark: SparkSession, path: str, *, target: int = TARGET, partition_by: Sequence[str] = ()) -> int:
    """Pack the files of each partition that has several small ones into files of about ``target`` bytes; the number of bins.

    The rows stay the same.  A plain folder is adopted first, ``partition_by`` names its partition columns.
    """
    now = current(spark, path) or adopt(spark, path, partition_by)
    files = stored(small_files(spark, now, target), "files")
    sets = files.groupBy("folder").agg(F.ceil(F.count("*") / PACKED).alias("sets"))
    dealt = files.join(sets, "folder").withColumn("set", F.pmod(F.xxhash64("path"), F.col("sets"))).drop("sets")
    shape = "path string, length bigint, folder string, set bigint, bin bigint"
    bins = stored(dealt.select("path", "length", "folder", "set").groupBy("folder", "set").applyInPandas(_bins(target), shape), "bins")
    total = bins.select("folder", "set", "bin").distinct().count()
    if total == 0:
        return 0
    plain = {_plain(r[0]) for r in bins.select("folder").distinct().collect()}
    touched = {b: tuple(r for r in rels if _plain(_join(b, r)) in plain) for b, rels in now.parts.items()}
    number = _next(spark, path)
    # the bins of a folder have numbers in a row, so no two of them meet in a task
    place = F.pmod(F.xxhash64("folder") + F.col("bin") + F.col("set") * F.lit(PACKED), F.lit(total)).cast("int")
    rows = _read(spark, now, touched, file="_file")
    named = bins.select(_unescaped(F.col("path")).alias("_path"), place.alias("_bin"))
    placed = rows.join(named, _unescaped(F.col("_file")) == F.col("_path")).repartitionById(total, "_bin").drop("_file", "_path", "_bin")
    base, parts, _ = _written(placed, path, number, now.partition_by)
    left = {b: tuple(r for r in rels if r not in touched[b]) for b, rels in now.parts.items()}
    commit(spark, path, replace(now, number=number, parts={**{b: r for b, r in left.items() if r}, base: parts}))
    return total


def _unescaped(file: Column) -> Column:
    """A file's path without its scheme, escapes resolved."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(file, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), r"\+", "%2B"))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete what none of the last ``keep`` versions needs.  Folders of a change that may still be running stay."""
    numbers = _numbers(spark, path, "manifests")
    complete = [v for v in (_load(spark, path, n) for n in reversed(numbers)) if v][:keep]
    if not complete:
        return
    newest, oldest = complete[0].number, complete[-1].number
    live = {_plain(f) for v in complete for f in v.folders()}
    for n in _numbers(spark, path, "data"):
        base = f"{path}/{HOME}/data/{n}"
        if n > newest:
            continue
        for rel in list(_leaves(spark, base, len(complete[0].partition_by))):
            if _plain(_join(base, rel)) not in live:
                delete(spark, _join(base, rel))
        if not any(f == _plain(base) or f.startswith(_plain(base) + "/") for f in live):
            delete(spark, base)
    for n in numbers:
        if n < oldest:
            delete(spark, _manifest(path, n))
