"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []
_NAME = re.compile(r"-[0-9a-f]{32}$")


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, or a folder in its warehouse if none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, but keeps column pruning and filter pushdown for
    everything that reads the result.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete every intermediate table of this process; frames that read them end here."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


def sweep(spark: SparkSession, hours: float = 48) -> int:
    """Delete intermediate tables of any run that are older than ``hours``, as runs that were killed leave theirs; returns how many."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    home = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = home.getFileSystem(conf)
    oldest = time.time() * 1000 - hours * 3_600_000
    old = [s.getPath() for s in (fs.listStatus(home) if fs.exists(home) else [])
           if s.isDirectory() and _NAME.search(s.getPath().getName()) and s.getModificationTime() < oldest]
    for path in old:
        fs.delete(path, True)
    return len(old)
