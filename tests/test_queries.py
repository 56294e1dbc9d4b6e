"""Every registered query against its DuckDB statement, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry
from cveflow import registry
from cveflow.oracle import sql

QUERIES, ORACLE = registry.QUERIES, sql.Q


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    assert compare.difference(df, duck, ORACLE[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
