"""Tables that hold every odd case, and DuckDB over the given ones."""

from __future__ import annotations

import duckdb
from pyspark.sql import types as T

#: Extra columns named like those that operators use inside.
CLASHING = ("row", "n", "key", "node", "label", "score", "pii", "name", "level", "shard", "root", "bucket")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING])

SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards watch from a tall tower in the north"


def _odd_texts() -> list[str | None]:
    words = [f"w{i % 977}x{i % 31}" for i in range(30_000)]
    near = [f"q{i}" for i in range(200)]
    return [
        None, "", " ", "\n\t ", "a", "one two three", SENTENCE, SENTENCE, SENTENCE.replace(" ", "  "), SENTENCE.upper(),
        "x" * 200_000, " ".join(words), " ".join(near), " ".join([*near[:-1], "other"]), "日本語 текст 😀 é́ \x00 ▁▁ a▁",
        "1" * 40_000, "." * 5_000 + "@" + "a." * 3_000, "9 " * 3_000, "mail a@b.cd, c@d.ef; 10.0.0.1 +1 (702) 555-0742 4111 1111 1111 1111",
        "<|endoftext|> and <s> </s> <0x0A> <unk>",
    ]


def odd_rows() -> list[tuple]:
    rows = [(i, t, "en", "s", None) for i, t in enumerate(_odd_texts())]
    rows += [(None, "no id here at all", None, None, None), (None, None, None, None, None)]
    rows += [rows[6]] * 2
    return [r + ("clash",) * len(CLASHING) for r in rows]


def make(spark, texts: list[str | None], first: int = 0):
    """Documents with the given texts and running ids."""
    return spark.createDataFrame([(first + i, t, "en", "s", 0) for i, t in enumerate(texts)], T.StructType(SCHEMA.fields[:5]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con
