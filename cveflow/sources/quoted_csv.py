"""CSV files with newlines in quoted fields, split over tasks like any text.

Whether a newline ends a record depends on the number of quotes before it, which a task that starts inside a file doesn't know.
So each task first counts the quotes and both kinds of line starts of its blocks: lines that begin outside of quotes if the block does,
and those that do if the block begins inside.  A prefix sum over the blocks of a file, of which there are few, tells which kind holds
where and how many records came before.  The blocks, no more than the splits that the driver plans, are broadcast, so lines stay where they are
read and are joined there to records.  Only a record that goes on in the next block, or in the next batch of lines of its task, is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BLOCKS = "file string, block bigint, quotes bigint, even bigint, odd bigint"
PARTS = "file string, number bigint, block bigint, line bigint, value string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """Each batch with the rows where a block starts, and whether its first row goes on with the block of the batch before.

    Rows come as they are read, so those of a block one after the other.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        names = batch.column("file").dictionary_encode()
        file = names.indices.to_numpy()
        new = np.ones(len(block), bool)
        new[1:] = (block[1:] != block[:-1]) | (file[1:] != file[:-1])
        here = [(names.dictionary[int(file[n])].as_py(), int(block[n])) for n in (0, -1)]
        yield batch, np.flatnonzero(new), here[0] == last
        last = here[1]


def _before(x: np.ndarray, first: np.ndarray, carried: int) -> np.ndarray:
    """The sum of the values before each one in its block, ``carried`` more in the first block."""
    total = np.cumsum(x) - x
    start = total[first]
    start[0] -= carried
    return total - np.repeat(start, np.diff(first, append=len(x)))


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[c.split()[0] for c in schema.split(", ")])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part of a block in a batch, its quotes and the lines that follow an even or odd number of quotes in the block."""
    carried = 0
    for batch, first, goes_on in _runs(batches):
        quotes = batch.column("quotes").to_numpy()
        before = _before(quotes, first, carried if goes_on else 0)
        carried = before[-1] + quotes[-1]
        odd = np.add.reduceat(before % 2, first)
        lines = np.diff(first, append=len(quotes))
        yield _batch([batch.column("file").take(pa.array(first)), batch.column("block").take(pa.array(first)),
                      np.add.reduceat(quotes, first), lines - odd, odd], BLOCKS)


def _joined(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """The records that lie in one block and one batch, or the parts of those that don't."""
    carried = (0, 0, 0)
    for batch, first, goes_on in _runs(batches):
        quotes, inside = batch.column("quotes").to_numpy(), batch.column("inside").to_numpy()
        carried = carried if goes_on else (0, 0, 0)
        before = _before(quotes, first, carried[0])
        begins = (before + inside) % 2 == 0
        begun = _before(begins.astype(np.int64), first, carried[1])
        line = _before(np.ones(len(quotes), np.int64), first, carried[2])
        carried = before[-1] + quotes[-1], begun[-1] + begins[-1], line[-1] + 1
        starts = begins.copy()
        starts[first] = True
        at = np.flatnonzero(starts)
        ends = np.append(at[1:], len(quotes))
        closed = (before + quotes + inside)[ends - 1] % 2 == 0
        kept = np.flatnonzero((begins[at] & closed) == whole)
        if len(kept):
            lines = pa.ListArray.from_arrays(pa.array(np.append(at, len(quotes)), pa.int32()), batch.column("value")).take(pa.array(kept))
            at = at[kept]
            number = (batch.column("earlier").to_numpy() + begun + begins - 1)[at]
            file, block = (batch.column(c).take(pa.array(at)) for c in ("file", "block"))
            yield _batch([file, number, block, line[at], pc.binary_join(lines, "\n")], PARTS)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, number, value``: the records of every file, numbered from 0; newlines inside quotes stay."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), quotes.cast("bigint").alias("quotes"))
    blocks = lines.select("file", "block", "quotes").mapInArrow(_counted, BLOCKS).groupBy("file", "block").agg(
        *[F.sum(c).alias(c) for c in ("quotes", "even", "odd")])
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(order), F.lit(0)) % 2)
    starts = F.when(F.col("inside") == 1, F.col("odd")).otherwise(F.col("even"))
    placed = opened.select("file", "block", "inside", F.coalesce(F.sum(starts).over(order), F.lit(0)).alias("earlier"))
    joined = lines.join(F.broadcast(placed), ["file", "block"])
    pieces = joined.mapInArrow(lambda batches: _joined(batches, False), PARTS).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
    whole = joined.mapInArrow(lambda batches: _joined(batches, True), PARTS).select("file", "number", "value")
    return whole.unionByName(pieces.select("file", "number", F.array_join(F.col("lines")["value"], "\n").alias("value")))


def read(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The fields of all records as strings, named by the header of the first file; a quote in a field is doubled.

    A file with another header fails the job.  Blank lines between records are skipped.
    """
    header = spark.read.csv(path, header=True, escape='"', inferSchema=False, multiLine=True).columns
    schema = ", ".join(f"`{c}` string" for c in header)
    options = {"escape": '"', "mode": "PERMISSIVE"}
    rows = records(spark, path).where(F.trim("value") != "").select("number", F.from_csv("value", schema, options).alias("row"))
    names = F.array(*[F.col("row")[c] for c in header])
    wrong = F.raise_error(F.concat(F.lit("a file has other columns: "), F.to_json(names))).cast("boolean")
    data = F.when(F.col("number") > 0, True).when(names == F.array(*map(F.lit, header)), False).otherwise(wrong)
    return rows.where(data).select("row.*")
