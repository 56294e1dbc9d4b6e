"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch's distinct words become one flat array of symbols.  Each round looks up the rank of every pair of
neighbours, takes the smallest rank per word, merges its leftmost pair in all words at once and
closes the gaps, until no pair is left.  Where no piece that extends the merged one ranks as high, all
its pairs in the word are merged in the same round, which is what one by one would give.  Words start
at a space mark; no piece has one behind another character, so words can't affect each other.

Workers remember the ids of words they have met, up to ``CACHE`` words.

Nulls: a null text counts as empty and encodes to the end id; null ids decode to an empty text.  Texts without spaces are
one long word.  Every row is coded by itself, so repeated ids and rows give a row each.  An empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cveflow.llm.arrow import lists, offsets, ranges, slices, strings
from cveflow.llm.frames import texts

#: Words a worker remembers before it starts anew, and ids that it keeps for them.
CACHE = 400_000
CACHE_IDS = 4_000_000
#: Code points that merge rounds work on at once.
ROUND_CHARS = 1 << 20

MARK = "▁"
#: Types of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Fixed value: what an unknown id decodes to.
UNKNOWN_TEXT = " ⁇ "
#: Symbols of characters that are in no piece start here.
FOREIGN = 1 << 24
NONE = np.int32(2**31 - 1)

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))
_WORD = re.compile(f"{MARK}({MARK}*[^{MARK}]*)")
_state: dict = {}


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    """Tables of a SentencePiece BPE model with byte fallback and no text normalisation."""

    def __init__(self, data: bytes):
        pieces, normalizer = [], {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif field == 3:
                normalizer = dict(_fields(value))
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1):
            raise ValueError("only models without normalisation, with a leading space mark, are supported")
        merging = [i for i, p in enumerate(pieces) if p[2] in (NORMAL, UNUSED)]
        if any(p[2] in (USER_DEFINED, UNUSED) for p in pieces) or sum(p[2] == BYTE for p in pieces) != 256:
            raise ValueError("only models with byte fallback, without user-defined or unused pieces, are supported")
        if any(MARK in pieces[i][0].lstrip(MARK) for i in merging):
            raise ValueError("pieces with a space mark behind another character are not supported")
        self.end = next(i for i, p in enumerate(pieces) if p[2] == CONTROL and p[0] == "</s>")
        self._symbols(pieces, merging)
        self._pairs(pieces, merging)
        self._texts(pieces)

    def _symbols(self, pieces, merging):
        """Symbols are ids; characters that only occur inside pieces get numbers behind the ids."""
        self.symbol = {pieces[i][0]: i for i in merging}
        for i in merging:
            for char in pieces[i][0]:
                self.symbol.setdefault(char, len(pieces) + len(self.symbol))
        self.of_char = np.arange(0x110000, dtype=np.int32) + FOREIGN
        self.char_of = np.zeros(max(self.symbol.values()) + 1, np.int32)
        for text, symbol in self.symbol.items():
            if len(text) == 1:
                self.of_char[ord(text)] = symbol
                self.char_of[symbol] = ord(text)
        self.n_pieces = len(pieces)
        self.byte = np.zeros(256, np.int32)
        for i, (text, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte[int(text[3:5], 16)] = i

    def _pairs(self, pieces, merging):
        """An open-addressing table from a pair of symbols to the piece they make; rank and reach of each piece."""
        scores = sorted({pieces[i][1] for i in merging}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(len(self.char_of), NONE, np.int32)
        for i in merging:
            self.rank[i] = place[pieces[i][1]]
        keys, values = [], []
        alone = np.ones(len(self.char_of), bool)
        for i in merging:
            text = pieces[i][0]
            for cut in range(1, len(text)):
                left, right = self.symbol.get(text[:cut]), self.symbol.get(text[cut:])
                if left is not None and right is not None:
                    keys.append((left << 32) | right)
                    values.append(i)
                for part in (left, right):
                    # a longer piece that ranks as high may follow at once
                    if part is not None and self.rank[i] <= self.rank[part]:
                        alone[part] = False
        self.alone = alone
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == -1
            first = np.unique(slot[left[free]], return_index=True)[1]
            put = left[free][first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            taken = self.keys[slot[left]] != keys[left]
            slot[left[taken]] = (slot[left[taken]] + 1) & ((1 << self.bits) - 1)
            left = left[taken]

    def _texts(self, pieces):
        out = []
        for text, _, kind in pieces:
            if kind == BYTE:
                out.append(bytes([int(text[3:5], 16)]))
            elif kind == UNKNOWN:
                out.append(UNKNOWN_TEXT.encode())
            else:
                out.append(b"" if kind == CONTROL else text.replace(MARK, " ").encode())
        self.text_sizes = np.array([len(t) for t in out], np.int64)
        self.text_starts = np.cumsum(self.text_sizes) - self.text_sizes
        self.text_bytes = np.frombuffer(b"".join(out), np.uint8)
        self.marked = np.array([t.startswith(MARK) for t, _, _ in pieces])
        self.control = np.array([k == CONTROL for _, _, k in pieces])
        self.high = np.zeros(len(pieces), bool)
        self.high[self.byte[128:]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1."""
        keys = (left.astype(np.int64) << 32) | right
        found = np.full(len(keys), -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            here = self.keys[slot]
            hit = here == keys[todo]
            found[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (here != -1)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return found

    def merge_rounds(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and size of each word; ``starts`` of non-empty words in ``symbols``."""
        n_words = len(starts)
        word = np.repeat(np.arange(n_words), np.diff(np.append(starts, len(symbols))))
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def pairs(at):
            """Piece of the symbol at each place with the one behind it in the same word."""
            found = np.full(len(at), -1, np.int32)
            inner = at + 1 < len(symbols)
            inner[inner] = word[at[inner]] == word[at[inner] + 1]
            found[inner] = self.merged(symbols[at[inner]], symbols[at[inner] + 1])
            return found

        pair = pairs(np.arange(len(symbols)))
        while len(symbols):
            rank = np.where(pair >= 0, self.rank[pair], NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            finished = best == NONE
            if finished.any():
                # words without a pair leave
                out = np.repeat(finished, sizes)
                done.append((word[out], symbols[out]))
                stay = ~out
                symbols, word, pair, rank = symbols[stay], word[stay], pair[stay], rank[stay]
                if not len(symbols):
                    break
                sizes, best = sizes[~finished], best[~finished]
                starts = np.cumsum(sizes) - sizes
            chosen = np.flatnonzero((rank == np.repeat(best, sizes)) & (rank != NONE))
            first = np.append(True, word[chosen[1:]] != word[chosen[:-1]])
            # of neighbouring pairs that share a symbol every other one is taken
            run = np.append(True, (chosen[1:] != chosen[:-1] + 1)) | first
            begin = np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
            even = (np.arange(len(chosen)) - begin) % 2 == 0
            left = chosen[even]
            left = left[self._in_order(symbols, word, pair, left)]
            symbols[left] = pair[left]
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, pair = symbols[keep], word[keep], pair[keep]
            changed = place[left]
            changed = np.unique(np.concatenate((changed, changed[changed > 0] - 1)))
            pair[changed] = pairs(changed)
        words = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(words, kind="stable")
        flat = np.concatenate([d[1] for d in done])[order] if done else np.zeros(0, np.int32)
        return flat, np.bincount(words, minlength=n_words)

    def _in_order(self, symbols: np.ndarray, word: np.ndarray, pair: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Which of the pairs at ``left`` merge now: in each word, those up to the first whose piece can be extended by as high a rank."""
        extends = ~self.alone[pair[left]]
        at = np.flatnonzero(extends)
        if not len(at):
            return np.ones(len(left), bool)
        place = left[at]
        made, rank = pair[place], self.rank[pair[place]]
        # the neighbour in front may have become a piece just before
        front = symbols[np.maximum(place - 1, 0)].copy()
        follows = (at > 0) & (left[np.maximum(at - 1, 0)] == place - 2)
        front[follows] = pair[place[follows] - 2]
        higher = np.zeros(len(at), bool)
        for valid, one, two in (
            ((place > 0) & (word[np.maximum(place - 1, 0)] == word[place]), front, made),
            ((place + 2 < len(symbols)) & (word[np.minimum(place + 2, len(symbols) - 1)] == word[place]), made,
             symbols[np.minimum(place + 2, len(symbols) - 1)]),
        ):
            found = np.full(len(at), -1, np.int32)
            found[valid] = self.merged(one[valid], two[valid])
            higher |= (found >= 0) & (self.rank[found] <= rank)
        stops = np.zeros(len(left), np.int64)
        stops[at] = higher
        before = np.cumsum(stops) - stops
        starts = np.append(True, word[left[1:]] != word[left[:-1]])
        return before == np.repeat(before[starts], np.diff(np.append(np.flatnonzero(starts), len(left))))

    def to_ids(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids; characters outside the vocabulary become the ids of their bytes."""
        foreign = symbols >= self.n_pieces
        if not foreign.any():
            return symbols, sizes
        outside = symbols[foreign]
        char = np.where(outside >= FOREIGN, outside - FOREIGN, self.char_of[np.where(outside >= FOREIGN, 0, outside)])
        encoded = [chr(c).encode() for c in char.tolist()]
        width = np.ones(len(symbols), np.int64)
        width[foreign] = [len(b) for b in encoded]
        ids = np.repeat(symbols, width)
        ids[np.repeat(foreign, width)] = self.byte[np.frombuffer(b"".join(encoded), np.uint8)]
        ends = np.cumsum(np.append(0, width))
        bounds = np.cumsum(np.append(0, sizes))
        return ids, np.diff(ends[bounds])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each led by a space mark, and how many each has."""
        chars = np.frombuffer("".join([MARK + w for w in words]).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return self.to_ids(*self.merge_rounds(self.of_char[chars].copy(), np.cumsum(sizes) - sizes))

    def decode(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """Texts of id sequences; ``at`` holds the offset of each sequence in ``ids``."""
        sizes, starts = self.text_sizes[ids].copy(), self.text_starts[ids].copy()
        # the mark that encoding puts before a text goes: that of the first id which isn't a control id
        plain = np.flatnonzero(~self.control[ids])
        lead = np.searchsorted(plain, at[:-1])
        lead = plain[lead[lead < len(plain)]] if len(plain) else plain
        owner = np.searchsorted(at, lead, "right") - 1
        lead = lead[np.append(True, owner[1:] != owner[:-1])] if len(lead) else lead
        lead = lead[self.marked[ids[lead]]]
        sizes[lead] -= 1
        starts[lead] += 1
        data = self.text_bytes[ranges(starts, sizes)]
        bounds = np.cumsum(np.append(0, sizes))[at]
        if self.high[ids].any():
            # a control id ends a run of bytes
            cuts = np.union1d(bounds, np.cumsum(np.append(0, sizes))[np.flatnonzero(self.control[ids])])
            parts = [data[a:b].tobytes().decode("utf-8", "each_byte") for a, b in zip(cuts[:-1], cuts[1:])]
            first = np.searchsorted(cuts, bounds)
            return pa.array(["".join(parts[a:b]) for a, b in zip(first[:-1], first[1:])], pa.string())
        return strings(data, bounds)


class Words(dict):
    """Number of each word met; their ids lie in ``ids`` from ``starts`` on.  Word 0 is the end of a text."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.reset()

    def reset(self):
        self.clear()
        self.pending: list[str] = []
        self.count = 1
        self.ids, self.used = np.array([self.model.end], np.int32), 1
        self.starts, self.sizes = np.array([0]), np.array([1])

    def __missing__(self, word: str) -> int:
        self[word] = number = self.count
        self.count += 1
        self.pending.append(word)
        return number

    def flush(self):
        """Encode the words met since the last call."""
        part: list[str] = []
        room = ROUND_CHARS
        ids, sizes = [self.ids], [self.sizes]
        for word in [*self.pending, None]:
            if part and (word is None or room < 0):
                found, lengths = self.model.encode_words(part)
                ids.append(found)
                sizes.append(lengths)
                part, room = [], ROUND_CHARS
            if word is not None:
                part.append(word)
                room -= len(word) + 1
        self.pending = []
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and offsets."""
        if len(self) > CACHE or len(self.ids) > CACHE_IDS:
            self.reset()
        numbers, sizes = [], []
        for text in batch:
            words = []
            if text:
                marked = MARK + text.replace(" ", MARK)
                words = _WORD.findall(marked) if MARK + MARK in marked or text[-1] == MARK else marked.split(MARK)[1:]
            numbers.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
            numbers.append(np.zeros(1, np.int64))
            sizes.append(len(words) + 1)
        if self.pending:
            self.flush()
        number = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        lengths = self.sizes[number]
        ends = np.cumsum(np.append(0, lengths))
        return self.ids[ranges(self.starts[number], lengths)], ends[np.cumsum(np.append(0, sizes))]


def _worker(shared) -> Words:
    """The codec of this Python worker."""
    key = hash(shared.value)
    if key not in _state:
        _state.clear()
        _state[key] = Words(Model(shared.value))
    return _state[key]


def _broadcast(df: DataFrame, model_path: str):
    with open(model_path, "rb") as file:
        data = file.read()
    Model(data)
    return df.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, model_path: str, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every document, the end id last; with ``decoded``, also ``decoded``, the text of the ids."""
    shared = _broadcast(docs, model_path)
    names = ["doc_id", "ids"] + ["decoded"] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker(shared)
        for whole in batches:
            for batch in slices(whole):
                ids, at = words.encode(batch.column("text").to_pylist())
                columns = [batch.column("doc_id"), lists(ids.astype(np.int32), at)]
                if decoded:
                    columns.append(words.model.decode(ids, at))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def counts(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens`` of every document, the end id among them."""
    shared = _broadcast(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker(shared)
        for whole in batches:
            for batch in slices(whole):
                at = words.encode(batch.column("text").to_pylist())[1]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at))], ["doc_id", "n_tokens"])

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint")


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, decoded`` for rows of ``doc_id, ids``."""
    shared = _broadcast(tokens, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _worker(shared).model
        for batch in batches:
            column = batch.column("ids")
            at = offsets(column)
            ids = np.asarray(column.values)[at[0] : at[-1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), model.decode(ids, at - at[0])], ["doc_id", "decoded"])

    rows = tokens.select("doc_id", F.coalesce("ids", F.expr("cast(array() as array<int>)")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, decoded string")
