"""SentencePiece codec and token counts against the libraries."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from cveflow.llm import piece_codec, queries, token_counts

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["the", "ing", "th", " ", "  ", "er", "e", "re", "in", "n", "o", "tt", "▁", "\n", "日", "é", "0", "hahaha", "==", "\t\t"]


def _library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _model():
    with open(PIECES, "rb") as file:
        return piece_codec.Model(file.read())


def test_encoding_equals_the_library(spark, odd, docs):
    library = _library()
    for table in (odd, docs):
        want = sorted((r.doc_id is None, r.doc_id or 0, library.encode(r.text or "", add_eos=True)) for r in table.collect())
        found = piece_codec.encode(table, PIECES, decoded=True).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in found) == want
        assert all(r.decoded == library.decode(r.ids) for r in found)


def test_random_texts_and_ids():
    library, words, rng = _library(), piece_codec.Words(_model()), random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(60))) for _ in range(2000)]
    ids, at = words.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library.encode(t, add_eos=True) for t in texts]
    some = [rng.choices(range(32_000), k=20) for _ in range(500)] + [[rng.randrange(3, 131) for _ in range(9)] + [1, 300] for _ in range(200)]
    at = np.cumsum([0, *map(len, some)])
    assert words.model.decode(np.concatenate([np.array(s) for s in some]), at).to_pylist() == [library.decode(s) for s in some]


def test_many_merges_in_one_long_word():
    library, words = _library(), piece_codec.Words(_model())
    text = "".join(random.Random(5).choices("abcdeh", k=20_000))
    assert words.encode([text])[0].tolist() == library.encode(text, add_eos=True)


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHE", 5)
    library, words = _library(), piece_codec.Words(_model())
    for text in ("one two three four five six", "seven one two", "one"):
        assert words.encode([text])[0].tolist() == library.encode(text, add_eos=True)


def test_decode_operator(spark):
    rows = spark.createDataFrame([(1, [1, 6312, 2]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    library = _library()
    assert {r.doc_id: r.decoded for r in piece_codec.decode(rows, PIECES).collect()} == {1: library.decode([1, 6312, 2]), 2: "", 3: ""}


def test_counts_equal_the_library(spark, odd, docs):
    library = Tokenizer.from_file(BYTES)
    for table in (odd, docs):
        want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()),
                       len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in table.collect())
        found = token_counts.count_tokens(table, BYTES).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found) == want


def test_counts_of_random_texts_with_a_small_cache():
    with open(BYTES, "rb") as file:
        encode = token_counts._encoder(file.read())
    rng = random.Random(9)
    parts = [*PARTS, "don't", " x", " ", "\x85", "\x1c", "᠎", "_", "!?", "٣", "ß"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]
    lengths = token_counts.Lengths(encode, ["the", "x"], bytes([1, 1]), 50)
    assert token_counts.count_texts(texts, lengths, None) == [encode(t) for t in texts]
    assert len(lengths) <= lengths.limit


def test_empty_tables(none):
    assert piece_codec.encode(none, PIECES, decoded=True).count() == 0
    assert token_counts.count_tokens(none, BYTES).count() == 0


def test_queries(spark, sf_dir):
    assert queries.op1_piece_codec(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert queries.op7_token_counts(spark, sf_dir).where("over_limit <> (n_tokens > 512)").count() == 0


def test_sketches_are_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "MERGES", 2)
    table = spark.range(0, 600, 1, 9).selectExpr("id as doc_id", "concat('the of w', id % 7, ' of the') as text")
    assert {"the", " the", " of"} <= set(token_counts.frequent_pieces(table, 64, 1 << 10))


def test_long_pieces_are_not_remembered():
    lengths = token_counts.Lengths(len, ["the"], bytes([1]), 50)
    assert lengths["x" * 1000] == 1000 and lengths["ab"] == 2
    assert set(lengths) == {"the", "ab"}


def test_every_character_is_split_as_the_library_splits():
    with open(BYTES, "rb") as file:
        encode = token_counts._encoder(file.read())
    lengths = token_counts.Lengths(encode, [], b"", 1000)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not 0xAC00 < c < 0xD7A3 and not 0x20000 < c < 0x2A000]
    # each between letters, digits, signs and spaces
    texts = ["".join(f"a{c}1{c}!{c} {c}" for c in chars[i : i + 8]) for i in range(0, len(chars), 8)]
    texts = [t for t in texts if token_counts.known(t)] + [t for t in texts if not token_counts.known(t)][::40]
    assert token_counts.count_texts(texts, lengths, None) == [encode(t) for t in texts]


def test_unknown_characters_are_left_to_the_library():
    with open(BYTES, "rb") as file:
        encode = token_counts._encoder(file.read())
    lengths = token_counts.Lengths(encode, [], b"", 1000)
    unknown = [chr(c) for c in (0x378, 0x558, 0xA7CE, 0x10940, 0x323B0, 0x3D000, 0xE0080)]
    texts = [f"a{c}b 1{c}2 !{c}{c}x" for c in unknown]
    assert token_counts.count_texts(texts, lengths, None) == [encode(t) for t in texts]
    assert all(token_counts.known(p) for p in lengths)


def test_texts_without_spaces_go_through_the_table():
    seen = []
    lengths = token_counts.Lengths(lambda piece: seen.append(piece) or 1, [], b"", 1000)
    assert token_counts.count_texts(["word,next(12)\nword,next(12)"], lengths, None) == [13]
    assert sorted(seen) == sorted(["word", ",", "next", "(", "12", ")", "\n"])


def test_stretches_of_long_texts(monkeypatch):
    with open(BYTES, "rb") as file:
        encode = token_counts._encoder(file.read())
    rng = random.Random(11)
    texts = ["".join(rng.choices([*PARTS, "don't", " x", "   ", "\u0378", "!?"], k=rng.randrange(200))) for _ in range(500)]
    monkeypatch.setattr(token_counts, "STRETCH", 7)
    assert all("".join(token_counts.stretches(t)) == t for t in texts)
    assert token_counts.count_texts(texts, token_counts.Lengths(encode, [], b"", 1000), None) == [encode(t) for t in texts]
