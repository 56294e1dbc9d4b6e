"""Security-advisory analytics on Spark DataFrames.

Every transform is ``DataFrame -> DataFrame``: it takes its clock and batch id as
arguments, runs no job and collects nothing.  Only ``sinks``, ``daily.run``, ``scratch.stored``
and ``ingest`` start jobs.
"""

from cveflow import daily, schema, scratch, sinks
from cveflow.functions import ids, values
from cveflow.operators import dedup, merge
from cveflow.plans import clean, kpis, master, readiness, risk, trends, views
from cveflow.sources import feeds, planning, testfeeds
from cveflow.streaming import ingest

__all__ = [
    "clean", "daily", "dedup", "feeds", "ids", "ingest", "kpis", "master", "merge", "planning",
    "readiness", "risk", "schema", "scratch", "sinks", "testfeeds", "trends", "values", "views",
]
