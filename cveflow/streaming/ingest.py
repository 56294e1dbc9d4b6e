"""Incremental pickup of new feed files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cveflow import versions
from cveflow.operators.dedup import latest_by
from cveflow.scratch import stored

EPOCH, BUCKET = "epoch", "bucket"


def ingest_incremental(
    spark: SparkSession,
    in_dir: str,
    schema: StructType | str,
    on_batch: Callable[[DataFrame, int], None],
    *,
    checkpoint: str,
    fmt: str = "json",
    max_files: int | None = None,
    file: str | None = None,
) -> StreamingQuery:
    """Process the files that arrived since the last run, then stop.

    The checkpoint remembers the files seen, so it takes the place of a high-water mark.  It must
    lie in a folder that survives the run.  With ``file``, batches have a column of that name with the path of each row's file.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(in_dir)
    if file:
        rows = rows.select("*", F.col("_metadata.file_path").alias(file))
    return (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def to_table(path: str) -> Callable[[DataFrame, int], None]:
    """Append every batch under its own number; a repeated batch overwrites itself.

    A lost checkpoint would start again with batch 0 beside the batches of before; that fails.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        later = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{EPOCH}={epoch + 1}")
        if later.getFileSystem(spark._jsc.hadoopConfiguration()).exists(later):
            raise ValueError(f"{path} holds later batches than {epoch}: its checkpoint is not the one it was written with")
        batch.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")

    return write


def to_keyed(
    path: str, keys: Sequence[str], order_cols: Sequence[str], *, buckets: int = 64, file: str = "_file", tiebreak: Sequence[str] | None = None
) -> Callable[[DataFrame, int], None]:
    """Upsert every batch into a versioned table by key; of rows with the same key the newest by ``order_cols`` stays, whatever came first.

    The ledger beside the table names the files taken in, and grows by the same commit as the table.  So a repeated batch, or a new checkpoint
    that delivers all files again, changes nothing: their rows are left out.  Batches need the column ``file``.

    The table is partitioned by a hash of the key into ``buckets``, and a batch writes those it has changes in.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        taken = versions.taken_in(spark, versions.current(spark, path))
        fresh = stored(batch.join(taken, batch[file] == taken["file"], "left_anti"), "batch")
        if fresh.isEmpty():
            return
        newest = latest_by(fresh.drop(file), keys, order_cols, tiebreak=tiebreak)
        newest = newest.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        versions.merge(newest, path, keys, partition_by=[BUCKET], order_cols=order_cols, files=fresh.select(F.col(file).alias("file")))
        versions.vacuum(spark, path)

    return write


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``to_keyed`` keeps."""
    return versions.read(spark, path).drop(BUCKET)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)
