"""Table writers.  Each counts its rows while writing, without a second scan.

A target is a folder, or the name of a catalog table if it has no slash.  ``append``, ``overwrite`` and ``clustered`` write plain Parquet;
``publish``, ``merge_table`` and ``compact`` write versioned tables (see ``versions``), which a crash never leaves half done.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cveflow import versions
from cveflow.operators.merge import upsert
from cveflow.schema import RUN_DATE

__all__ = [
    "append", "clustered", "compact", "exists", "home", "merge_table", "overwrite", "point", "publish", "read", "upsert",
    "write_observed",
]


def _named(target: str) -> bool:
    return "/" not in target


def exists(spark: SparkSession, table: str) -> bool:
    """Whether a catalog table is there; one whose first view was lost to a crash gets it back."""
    if not spark.catalog.tableExists(table) and versions.current(spark, home(spark, table)):
        point(spark, table)
    return spark.catalog.tableExists(table)


def read(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table, or of a folder, plain or versioned."""
    if _named(target):
        return spark.table(target)
    return versions.read(spark, target) if versions.current(spark, target) else spark.read.parquet(target)


def write_observed(
    df: DataFrame,
    path: str,
    *,
    mode: str,
    partition_by: Sequence[str] = RUN_DATE,
    rebalance: bool = False,
) -> Observation:
    """Write Parquet; ``observation.get['rows']`` is the number of rows written.

    ``rebalance`` is for tables that span many partitions: it brings the rows of a partition
    together, so that not every task writes a file into every partition, and adaptive execution
    splits the large partitions over several tasks again.
    """
    seen = Observation("written")
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format("parquet").saveAsTable(path) if _named(path) else writer.parquet(path)
    return seen


def append(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = RUN_DATE, rebalance: bool = False
) -> Observation:
    return write_observed(df, path, mode="append", partition_by=partition_by, rebalance=rebalance)


def overwrite(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = RUN_DATE, rebalance: bool = False
) -> Observation:
    return write_observed(df, path, mode="overwrite", partition_by=partition_by, rebalance=rebalance)


def clustered(
    df: DataFrame,
    path: str,
    *,
    cluster_by: str,
    partitions: int | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> Observation:
    """Range-cluster the files on one column, so that a filter on it skips files and row groups.

    A value that holds many rows would be one range; a hash of the row as second range column
    splits it over several files.
    """
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranges = [*[F.col(c) for c in partition_by], F.col(cluster_by), spread]
    ranged = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    return write_observed(
        ranged.sortWithinPartitions(*partition_by, cluster_by), path, mode=mode, partition_by=partition_by
    )


def home(spark: SparkSession, target: str) -> str:
    """The folder of a target's versions: the target itself, or a folder beside the tables of its database."""
    if not _named(target):
        return target.rstrip("/")
    database, _, name = target.rpartition(".")
    at = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{at.rstrip('/')}/{name}__store"


def merge_table(
    df: DataFrame, target: str, keys: Sequence[str], *, cluster_by: str | None = None, partition_by: Sequence[str] = RUN_DATE,
    ignore: Sequence[str] = (), keep: int = 2,
) -> int:
    """Create a versioned table, or upsert ``df`` into it; the number of rows written.

    Killed at any point, the table has its old rows or the merged ones, and the next merge goes on from there.  Partitions without a
    change are taken over as they are; differences in the columns ``ignore`` alone are none.  ``keep`` versions stay on disk.
    """
    spark, where = df.sparkSession, home(df.sparkSession, target)
    if versions.current(spark, where) is None and _named(target) and spark.catalog.tableExists(target):
        # a plain table becomes the first version
        rows = versions.publish(upsert(spark.table(target), df, keys), where, partition_by=partition_by, cluster_by=cluster_by)
    else:
        rows = versions.merge(df, where, keys, partition_by=partition_by, cluster_by=cluster_by, ignore=ignore)
    _finish(spark, target, where, keep)
    return rows


def publish(
    df: DataFrame, target: str, *, cluster_by: str | None = None, partition_by: Sequence[str] = RUN_DATE, keep: int = 2
) -> int:
    """Create a versioned table, or replace all its rows at once; the number of rows written.  ``df`` may read the table."""
    spark, where = df.sparkSession, home(df.sparkSession, target)
    rows = versions.publish(df, where, partition_by=partition_by, cluster_by=cluster_by)
    _finish(spark, target, where, keep)
    return rows


def compact(spark: SparkSession, target: str, *, size: int = versions.TARGET, partition_by: Sequence[str] = (), keep: int = 2) -> int:
    """Pack small files of a versioned table, or of a plain folder, which becomes one; the number of files written, about."""
    where = home(spark, target)
    files = versions.compact(spark, where, target=size, partition_by=partition_by)
    _finish(spark, target, where, keep)
    return files


def _finish(spark: SparkSession, target: str, where: str, keep: int) -> None:
    if _named(target):
        point(spark, target, keep)
    versions.vacuum(spark, where, keep)


def point(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Make ``table`` a view of its current version; replacing the view is the only step that readers can see.

    A version is a table of its own, ``<table>__v<n>``, whose partitions lie in the folders of the version.  A plain table of that name is
    renamed to ``<table>__v0`` first; it is dropped with the old versions.
    """
    version = versions.current(spark, home(spark, table))
    snapshot = f"{table}__v{version.number}"
    there = spark.catalog.tableExists(table)
    view = there and spark.catalog.getTable(table).tableType == "VIEW"
    if not view or {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get("version") != str(version.number):
        _snapshot(spark, version, snapshot)
        if there and not view:
            spark.sql(f"ALTER TABLE {table} RENAME TO {table}__v0")
        columns = ", ".join(f"`{c}`" for c in version.schema.names)
        spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('version' = '{version.number}') AS SELECT {columns} FROM {snapshot}")
    database, _, name = table.rpartition(".")
    found = [t.name for t in spark.catalog.listTables(database or None) if not t.isTemporary and t.name.startswith(f"{name}__v".lower())]
    numbers = sorted(int(n.rpartition("__v")[2]) for n in found if n.rpartition("__v")[2].isdigit())
    for n in [n for n in numbers if n <= version.number][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {table}__v{n}")


def _snapshot(spark: SparkSession, version: versions.Version, name: str) -> None:
    """Register the folders of a version as a table that doesn't own them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns, parts = version.schema.toDDL(), version.folders()
    if not version.partition_by:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{_quoted(parts[0])}'")
        return
    first = next(iter(version.parts))
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in version.partition_by)})"
        f" LOCATION '{_quoted(first)}'")
    for at in range(0, len(parts), 500):
        spec = " ".join(f"PARTITION ({_values(folder, version.partition_by)}) LOCATION '{_quoted(folder)}'" for folder in parts[at : at + 500])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec}")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _values(folder: str, partition_by: Sequence[str]) -> str:
    """The partition values a folder's name stands for."""
    pairs = [p.split("=", 1) for p in folder.split("/")[-len(partition_by) :]]
    spelled = ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{_quoted(unquote(v))}'" for _, v in pairs)
    return ", ".join(f"`{c}` = {v}" for c, v in zip(partition_by, spelled))
