"""Run a registered query and its DuckDB statement and compare rows by column name."""

from __future__ import annotations

import duckdb

TABLES = ("orders", "lineitem")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", "") for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    return columns, sorted(rows, key=_key)


def duck_rows(con, statement: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def type_difference(df, con, statement: str) -> list[tuple]:
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {statement}").fetchall()}
    have = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    return [(n, have[n], want.get(n)) for n in have if have[n] != want.get(n)]


def difference(df, con, statement: str) -> str:
    """Empty if equal, else a short description."""
    types = type_difference(df, con, statement)
    if types:
        return f"types {types}"
    have_names, have = spark_rows(df)
    want_names, want = duck_rows(con, statement)
    if have_names != want_names:
        return f"columns {have_names} != {want_names}"
    if len(have) != len(want):
        return f"{len(have)} rows, expected {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"{[(n, x, y) for n, x, y in zip(have_names, a, b) if x != y][:4]}"
    return ""
