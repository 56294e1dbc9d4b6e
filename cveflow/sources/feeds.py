"""Readers for the published feed files, and the steps that turn them into raw tables.

JSON feeds come as one document per file; ``lines=True`` reads one document per line instead, which
lets a large file be split over many tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cveflow import schema as s
from cveflow.functions import values as v
from cveflow.sources import quoted_csv
from cveflow.sources.planning import high_water_mark, plan_offsets, plan_windows
from cveflow.streaming.ingest import ingest_incremental

__all__ = [
    "high_water_mark", "ingest_incremental", "or_empty", "plan_offsets", "plan_windows", "read_epss",
    "read_exploits", "read_kev", "read_modules", "read_nvd", "stamp", "top_up",
]

# What an absent nested field is stored as.
NVD_DEFAULTS = {
    "cveTags": "[]", "descriptions": "[]", "metrics": "{}", "weaknesses": "[]",
    "configurations": "[]", "references": "[]",
}
MODULE_JSON = {
    "aliases": "[]", "platform": "[]", "arch": "[]", "autofilter_ports": "[]",
    "autofilter_services": "[]", "targets": "[]", "notes": "{}", "session_types": "[]",
    "actions": "[]", "author": "[]", "references": "[]",
}
# Module fields kept as the text of a scalar, whose spelling is True, False and None.
MODULE_SCALARS = (
    "rank", "rport", "is_install_path", "check", "post_auth", "default_credential", "needs_cleanup",
)


def _documents(spark: SparkSession, path: str | list[str], lines: bool) -> DataFrame:
    return spark.read.text(path, wholetext=not lines)


def _struct_of_strings(names: Sequence[str]) -> str:
    return "struct<" + ",".join(f"`{n}`:string" for n in names) + ">"


def read_nvd(spark: SparkSession, path: str | list[str], *, lines: bool = False) -> DataFrame:
    """Result pages of the vulnerability API: one row per record, nested fields as JSON text."""
    page = f"struct<vulnerabilities:array<struct<cve:{_struct_of_strings(s.NVD_FIELDS)}>>>"
    records = (
        _documents(spark, path, lines)
        .select(F.explode(F.from_json("value", page)["vulnerabilities"]).alias("item"))
        .select("item.cve.*")
    )
    return records.fillna(NVD_DEFAULTS)


def read_kev(spark: SparkSession, path: str | list[str], *, lines: bool = False) -> DataFrame:
    """Known-exploited catalogues: one row per entry with the catalogue's header fields."""
    header = ("catalogVersion", "dateReleased", "count")
    entry = [f for f in s.KEV_FIELDS if f not in header]
    document = ", ".join(f"{h} string" for h in header)
    document += f", vulnerabilities array<{_struct_of_strings(entry)}>"
    catalogues = spark.read.schema(document).json(path, multiLine=not lines)
    return catalogues.select(*header, F.inline("vulnerabilities")).select(*s.KEV_FIELDS)


def read_epss(
    spark: SparkSession, path: str | list[str], *, as_of: dt.date | str | None = None, dated: bool = False, split: bool = False
) -> DataFrame:
    """Score files (plain or compressed CSV): a comment line with the score date, a header, the rows.

    With ``dated`` the files lie in folders ``date=YYYY-MM-DD``, and the folder gives the date.  Otherwise a file is one row of text first, so its
    comment and its rows are read together, in one scan; the comment's date is put on its rows, and ``as_of`` where there is none.  A
    file is then read by one task, which suits files of a day.  ``split`` is for plain files too large for that: many tasks read one, and
    a second scan finds the comments.
    """
    names = ("cve", "epss", "percentile")
    fallback = F.lit(str(v.as_date(as_of)) if as_of is not None else None).cast("string")
    if dated:
        columns = s.strings((*names, "date"))
        return spark.read.csv(path, schema=columns, header=True, comment="#").select(*names, "date")
    if not split:
        files = spark.read.text(path, wholetext=True)
        comments = F.regexp_extract_all("value", F.lit(r"(?m)^#.*?score_date:(\d{4}-\d{2}-\d{2})"), F.lit(1))
        lines = F.filter(F.split("value", "\r?\n|\r"), lambda line: ~line.startswith("#") & (F.trim(line) != ""))
        rows = files.select(F.coalesce(F.array_max(comments), fallback).alias("date"), F.posexplode(lines).alias("line", "value"))
        schema = s.strings(names).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
        fields = rows.select("date", "line", F.from_csv("value", schema, {"mode": "PERMISSIVE"}).alias("row"))
        header = F.array(*[F.lower(F.trim(F.col("row")[n])) for n in names]) == F.array(*map(F.lit, names))
        wrong = F.raise_error(F.concat(F.lit("not the columns cve, epss, percentile: "), F.to_json("row"))).cast("boolean")
        return fields.where(F.when(F.col("line") > 0, True).when(header, False).otherwise(wrong)).select("row.*", "date")
    file = F.col("_metadata.file_path").alias("_file")
    rows = spark.read.csv(
        path, schema=s.strings(names), header=True, comment="#", enforceSchema=False
    ).select(*names, file)
    found = F.regexp_extract("value", r"score_date:(\d{4}-\d{2}-\d{2})", 1)
    dates = (
        spark.read.text(path)
        .select("value", file)
        .where(F.col("value").startswith("#") & (found != ""))
        .groupBy("_file")
        .agg(F.max(found).alias("date"))
    )
    return rows.join(dates, "_file", "left").select(
        *names, F.coalesce("date", fallback).alias("date")
    )


def read_exploits(
    spark: SparkSession, path: str | list[str], *, multiline: bool = False
) -> DataFrame:
    """Exploit index CSV with header; columns are taken by name.

    Large files are split over tasks, with ``multiline=True`` also where quoted fields hold newlines.
    """
    if multiline:
        table = quoted_csv.read(spark, path)
    else:
        table = spark.read.csv(path, header=True, escape='"', enforceSchema=False, inferSchema=False)
    return s.conform(table, s.strings(s.EXPLOIT_FIELDS)).fillna("")


def _module_field(name: str) -> Column:
    present = F.map_contains_key("meta", name)
    value = F.col("meta")[name]
    if name in MODULE_JSON:
        return F.when(present, F.coalesce(value, F.lit("null"))).otherwise(MODULE_JSON[name])
    if name in MODULE_SCALARS:
        spelled = (
            F.when(value.isNull(), "None").when(value == "true", "True").when(value == "false", "False")
            .otherwise(value)
        )
        return F.when(present, spelled).otherwise("")
    return F.when(present, value).otherwise("")


def read_modules(spark: SparkSession, path: str | list[str], *, lines: bool = False) -> DataFrame:
    """Module metadata, ``{fullname: {...}}``: one row per module."""
    entries = _documents(spark, path, lines).select(
        F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("fullname", "meta")
    )
    fields = [_module_field(n).alias(n) for n in s.MODULE_FIELDS if n != "fullname"]
    return entries.select("fullname", *fields)


def or_empty(spark: SparkSession, df: DataFrame | None, schema: StructType) -> DataFrame:
    """The frame in its declared schema, an empty one if the feed brought nothing."""
    return spark.createDataFrame([], schema) if df is None else s.conform(df, schema)


def stamp(
    df: DataFrame, *, now: dt.datetime | str, source: str, batch_id: str
) -> DataFrame:
    """Add the audit columns of one ingestion run."""
    stamped = df.withColumns({
        "_ingested_at": v.timestamp(now), "_source": F.lit(source), "_batch_id": F.lit(batch_id),
    })
    return v.run_date(stamped, v.as_time(now).date())


def top_up(df: DataFrame, extra: DataFrame) -> DataFrame:
    """``df`` and the supplementary rows, matched by column name; columns that ``extra`` lacks are NULL."""
    return df.unionByName(extra, allowMissingColumns=True)
