"""Token counts of a byte-level BPE by looking up the lengths of pre-tokens.

The tokenizer splits a text into pre-tokens and merges inside each, so they can be counted one by one.
Two tiers answer: a compact table of the corpus's frequent pre-tokens, found by a mergeable sketch of
bounded size and broadcast, and a bounded cache in each Python worker; only what both miss is encoded.
No pre-token is ever shuffled.  The sketch only decides what is looked up faster: counts are exact
whatever it finds.  A character that Python's Unicode tables don't know may be of another class to the
tokenizer; the stretch of text around one is encoded whole.

Nulls: a null text counts as empty and has no tokens.  An empty table gives an empty result.  Every row
is counted by itself, so repeated ids and rows give a row each.  A very long text is counted in stretches
of about ``STRETCH`` characters, as far as it has spaces to part it at.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from cveflow.llm.arrow import slices
from cveflow.llm.frames import texts

#: Entries of the broadcast table and their longest text: at most TABLE * (4 * PIECE_CHARS + 2) bytes.
TABLE = 1 << 15
PIECE_CHARS = 32
#: Items a sketch tracks; counts are off by at most about 3.5 / TRACKED of all pieces.
TRACKED = 1 << 16
#: Sketches that are merged at a time.
MERGES = 32
#: Pieces a worker remembers before it starts anew from the table, and their longest text.
CACHE = 400_000
CACHED_CHARS = 64

#: Characters of a text that are split into pre-tokens at a time, about.
STRETCH = 1 << 20

#: Fixed value: the pre-tokens of the tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PRE_TOKEN = regex.compile(PRE_TOKEN)
#: A pre-token always begins here.
_BORDER = re.compile(r" (?=[\w!-~])")
#: Makes a sum negative, whatever is added.
_UNSURE = -(1 << 60)
_state: dict = {}


def frequent_pieces(text: DataFrame, table: int = TABLE, tracked: int = TRACKED) -> list[str]:
    """At most ``table`` frequent pre-tokens of the corpus, from one pass over all of it."""
    piece = F.explode(F.regexp_extract_all("text", F.lit(PRE_TOKEN), F.lit(0))).alias("piece")
    pieces = text.select(piece).where((F.length("piece").between(1, PIECE_CHARS)) & ~F.contains("piece", F.lit("\n")))
    parts = pieces.groupBy(F.spark_partition_id().alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(piece, {tracked})").alias("sketch"))
    # a tree: no task merges more than MERGES sketches, however many there are
    n = text.rdd.getNumPartitions()
    while n > MERGES:
        n = -(-n // MERGES)
        parts = parts.groupBy((F.col("part") % n).alias("part")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    # grouped, as a task without sketches must not send an empty one
    top = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {table})").alias("top"))
    return [r.piece for r in top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("piece")).collect() if r.piece]


def known(piece: str) -> bool:
    """Whether all characters of a piece are assigned in Python's Unicode tables."""
    return piece.isascii() or all(unicodedata.category(c) != "Cn" for c in piece)


class Lengths(dict):
    """Tokens per pre-token; starts from the frequent ones, encodes what it doesn't know and remembers it if it isn't long."""

    def __init__(self, encode, frequent: list[str], lengths: bytes, limit: int):
        super().__init__(zip(frequent, lengths))
        self.encode, self.frequent, self.limit = encode, dict(self), limit + len(self)

    def __missing__(self, piece: str) -> int:
        if not known(piece):
            return _UNSURE
        count = self.encode(piece)
        if len(piece) > CACHED_CHARS:
            return count
        if len(self) >= self.limit:
            self.clear()
            self.update(self.frequent)
        self[piece] = count
        return count


def _encoder(model: bytes):
    """Counts of a text; the strings of special tokens are taken as those, none are added."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def _special(model: bytes) -> list[str]:
    import json

    return [t["content"] for t in json.loads(model)["added_tokens"]]


def stretches(text: str, limit: int | None = None) -> Iterator[str]:
    """Consecutive parts of a text of at least ``limit`` characters, cut where a pre-token begins."""
    limit, begin = limit or STRETCH, 0
    while len(text) - begin > limit and (cut := _BORDER.search(text, begin + limit)):
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def count_texts(batch: list[str], lengths: Lengths, special: re.Pattern | None) -> list[int]:
    """Tokens of each text."""
    counts = []
    for text in batch:
        parts = special.split(text) if special else [text]
        total = len(parts) - 1
        for part in parts:
            for stretch in stretches(part):
                count = sum(map(lengths.__getitem__, _PRE_TOKEN.findall(stretch)))
                total += count if count >= 0 else lengths.encode(stretch)
        counts.append(total)
    return counts


def count_tokens(docs: DataFrame, tokenizer_path: str, table: int = TABLE, cache: int = CACHE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every document, as the tokenizer file at ``tokenizer_path`` counts."""
    with open(tokenizer_path, "rb") as file:
        model = file.read()
    text = texts(docs)
    encode, special = _encoder(model), _special(model)
    # Java's classes may differ; what isn't a pre-token is just never looked up
    frequent = [p for p in frequent_pieces(text, table) if known(p) and not any(s in p for s in special)]
    short = [(p, n) for p, n in zip(frequent, map(encode, frequent)) if n < 256]
    shared = docs.sparkSession.sparkContext.broadcast(
        (model, "\n".join(p for p, _ in short), bytes(n for _, n in short)))
    pattern = "|".join(map(re.escape, special))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value[0]), hash(shared.value[1])
        if key not in _state:
            _state.clear()
            own, pieces, sizes = shared.value
            _state[key] = Lengths(_encoder(own), pieces.split("\n") if sizes else [], sizes, cache)
        split = re.compile(pattern) if pattern else None
        for whole in batches:
            for batch in slices(whole):
                found = count_texts(batch.column("text").to_pylist(), _state[key], split)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    rows = text.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
