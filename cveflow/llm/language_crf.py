"""Language of documents by a linear-chain conditional random field over their words.

A word's features are its affixes, its inner character n-grams and the word itself (the lexicon),
hashed; each has a weight for every language, and neighbouring words are tied by learned transitions.
Forward-backward over ``SEGMENT`` words at a time gives every word its language probabilities, in code-switched
text too; a document's language has the highest mean probability.

The fit uses the words of at most about ``FIT`` documents of each language, chosen by a hash of the id.  Every language
has the same share of ``FIT_WORDS``, taken in the order of another hash; a document gives at most a ``FIT_PARTS``-th of
it, in segments spread over its text.  As the documents are mostly in one language, every fourth training segment is
spliced from two documents, which teaches the transitions that a text may switch.  The ``LANGS`` languages of most
documents are learnt; with more than ``FIT_CELLS / FIT_WORDS`` of them, fewer words of each, so a fit has a bounded size.

Nulls: a text that is null or has no letter is ``und`` with score 0; documents without id or language
are not learnt from.  Without any language to learn everything is ``und``.  Every row is named by its own text, so repeated
ids and rows give a row each.  Ties: of equally likely languages the first by name.  A very long text is read whole,
``CELLS`` probabilities at a time.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cveflow.llm.arrow import ranges, slices
from cveflow.llm.frames import held_out, texts

#: Documents of each language that a fit uses, about, words of all languages together, and the least number of
#: documents that use up the words of a language, if its share has that many segments.
FIT = 300
FIT_WORDS = 1_000_000
FIT_PARTS = 50
#: Languages that are learnt (those of most documents, then by name), and words times languages of a fit.
LANGS = 64
FIT_CELLS = 16_000_000
SEGMENT = 64
BITS = 18
ORDERS = (2, 3, 4)
ROUNDS = 30
STEP = 0.1
DECAY = 1e-6
UNKNOWN = "und"
#: Words times languages whose scores a worker remembers before it starts anew, and that it works on at once, about.
CACHE = 5_000_000
CELLS = 4_000_000

_WORD = re.compile(r"[^\W\d_]+")
_state: dict = {}


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower())


def word_features(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one after the other, and how many each word has.

    A word stands between two marks, so n-grams at its ends are its affixes; the lexicon feature
    hashes the whole word.
    """
    chars = np.frombuffer("".join([f"\x02{w}\x03" for w in batch]).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, batch), np.int64, len(batch)) + 2
    word = np.repeat(np.arange(len(batch)), sizes)
    mixed = (chars + np.uint32(0x7F4A7C15)) * np.uint32(0x85EBCA6B)
    rolled, owners, found = mixed, [], []
    for n in range(2, max(ORDERS) + 1):
        if len(chars) < n:
            break
        rolled = (rolled[:-1] * np.uint32(0x01000193)) ^ mixed[n - 1 :]
        inside = word[n - 1 :] == word[: len(rolled)]
        owners.append(word[: len(rolled)][inside])
        found.append(rolled[inside])
    power = np.cumprod(np.full(int(sizes.max(initial=1)), 0x9E3779B1, np.uint64))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(chars)) - np.repeat(starts, sizes)
    if len(batch):
        whole = np.add.reduceat(mixed.astype(np.uint64) * power[place], starts)
        owners.append(np.arange(len(batch)))
        found.append((whole >> np.uint64(32)).astype(np.uint32) ^ whole.astype(np.uint32))
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    x = np.concatenate(found) if found else np.zeros(0, np.uint32)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = ((x ^ (x >> np.uint32(13))) * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS)
    order = np.argsort(owner, kind="stable")
    return x[order], np.bincount(owner, minlength=len(batch))


def summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of consecutive rows, ``sizes`` of them each (at least one)."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0)


def segments(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of the segments of documents with so many words."""
    full = -(-sizes // SEGMENT)
    begin = np.repeat(np.cumsum(sizes) - sizes, full)
    number = ranges(np.zeros(len(sizes), np.int64), full)
    return begin + number * SEGMENT, np.minimum(np.repeat(sizes, full) - number * SEGMENT, SEGMENT)


def forward_backward(
    emission: np.ndarray, start: np.ndarray, size: np.ndarray, first: np.ndarray, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each language for each word, and expected moves between neighbouring words.

    ``emission`` holds log scores of words; segments lie at ``start`` with ``size`` words each.
    """
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
    scores = np.exp(emission - emission.max(1, keepdims=True))
    step = np.exp(move - move.max())
    ahead = []
    for t in range(longest):
        rows = scores[start[: active[t]] + t]
        now = rows * (np.exp(first - first.max()) if t == 0 else ahead[-1][: active[t]] @ step)
        ahead.append(now / now.sum(1, keepdims=True))
    out = np.zeros_like(emission)
    moves = np.zeros_like(move)
    back = np.ones((len(start), len(first)))
    for t in range(longest - 1, -1, -1):
        n = active[t]
        both = ahead[t] * back[:n]
        out[start[:n] + t] = both / both.sum(1, keepdims=True)
        if t:
            behind = scores[start[:n] + t] * back[:n]
            joint = ahead[t - 1][:n, :, None] * step[None] * behind[:, None, :]
            moves += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            back[:n] = behind @ step.T
            back[:n] /= back[:n].sum(1, keepdims=True)
    return out, moves


class Crf:
    """Weights of features (``BITS`` bits, one column for each language), first words and moves."""

    def __init__(self, langs: list[str], weights: np.ndarray, first: np.ndarray, move: np.ndarray):
        self.langs, self.weights, self.first, self.move = langs, weights, first, move

    def pack(self) -> bytes:
        used = np.flatnonzero(np.any(self.weights != 0, 1)).astype(np.int32)
        parts = [used.tobytes(), self.weights[used].astype(np.float32).tobytes(), self.first.tobytes(), self.move.tobytes()]
        return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)

    @classmethod
    def unpack(cls, langs: list[str], data: bytes) -> Crf:
        bounds = np.cumsum(np.append(32, np.frombuffer(data[:32], np.int64)))
        used, values, first, move = (data[a:b] for a, b in zip(bounds[:-1], bounds[1:]))
        weights = np.zeros((1 << BITS, len(langs)), np.float32)
        weights[np.frombuffer(used, np.int32)] = np.frombuffer(values, np.float32).reshape(-1, len(langs))
        return cls(langs, weights, np.frombuffer(first), np.frombuffer(move).reshape(len(langs), -1))

    @classmethod
    def fit(cls, langs: list[str], docs: list[tuple[list[str], int]]) -> Crf:
        """Maximum likelihood of the labels of all words, by gradient steps on all segments at once."""
        k = len(langs)
        number: dict[str, int] = {}
        word = np.array([number.setdefault(w, len(number)) for d, _ in docs for w in d], np.int64)
        size = np.array([len(d) for d, _ in docs])
        label = np.repeat(np.array([y for _, y in docs]), size)
        start, size = segments(size)
        # the second half of every fourth segment comes from another one of the same length or more
        fourth = np.flatnonzero((np.arange(len(start)) % 4 == 0) & (size > 1))
        donor = np.random.default_rng(7).permutation(fourth)
        half = np.minimum(size[fourth], size[donor]) // 2
        into, out_of = ranges(start[fourth] + size[fourth] - half, half), ranges(start[donor] + size[donor] - half, half)
        spliced = word.copy()
        spliced[into], label = word[out_of], _put(label, into, label[out_of])
        word = spliced
        features, counts = word_features(list(number))
        used, local = np.unique(features, return_inverse=True)
        gold = np.eye(k)[label]
        inner = np.ones(len(word), bool)
        inner[start] = False
        behind = np.flatnonzero(inner)
        gold_moves = np.bincount(label[behind - 1] * k + label[behind], minlength=k * k).reshape(k, k)
        gold_first = gold[start].sum(0)
        owner = np.repeat(np.arange(len(counts)), counts)
        sizes = [len(used) * k, k, k * k]
        theta, one, two = np.zeros(sum(sizes)), 0.0, 0.0
        for step in range(1, ROUNDS + 1):
            w, first, move = (p.reshape(s) for p, s in zip(np.split(theta, np.cumsum(sizes)[:-1]), ((-1, k), k, (k, k))))
            emission = summed(w[local], counts)[word]
            seen, moves = forward_backward(emission, start, size, first, move)
            gap = seen - gold
            by_word = np.stack([np.bincount(word, gap[:, j], len(counts)) for j in range(k)], 1)
            slope_w = np.stack([np.bincount(local, by_word[owner, j], len(used)) for j in range(k)], 1)
            slope = np.concatenate((slope_w.ravel(), seen[start].sum(0) - gold_first, (moves - gold_moves).ravel()))
            slope = slope / len(word) + DECAY * theta
            one, two = 0.9 * one + 0.1 * slope, 0.999 * two + 0.001 * slope**2
            theta = theta - STEP * one / (1 - 0.9**step) / (np.sqrt(two / (1 - 0.999**step)) + 1e-10)
        w, first, move = (p.reshape(s) for p, s in zip(np.split(theta, np.cumsum(sizes)[:-1]), ((-1, k), k, (k, k))))
        weights = np.zeros((1 << BITS, k), np.float32)
        weights[used] = w
        return cls(langs, weights, first.copy(), move.copy())


def _put(values: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    out = values.copy()
    out[at] = new
    return out


class Scores(dict):
    """Number of each word met; ``table`` holds its log scores."""

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf = crf
        self.reset()

    def reset(self):
        self.clear()
        self.pending: list[str] = []
        self.table = np.zeros((0, len(self.crf.langs)))

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.pending.append(word)
        return number

    def label(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language probabilities of the words of all texts, and how many words each text has."""
        word, sizes = self.numbers(batch)
        return forward_backward(self.table[word], *segments(sizes), self.crf.first, self.crf.move)[0], sizes

    def judge(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Summed language probabilities of all texts, the likeliest language of each of their words, and how many words each text has."""
        word, sizes = self.numbers(batch)
        start, size = segments(sizes)
        owner = np.repeat(np.arange(len(batch)), -(-sizes // SEGMENT))
        total, best = np.zeros((len(batch), len(self.crf.langs))), np.zeros(len(word), np.int64)
        step = max(1, CELLS // (SEGMENT * len(self.crf.langs)))
        for i in range(0, len(start), step):
            begin, long = start[i : i + step], size[i : i + step]
            a, b = begin[0], begin[-1] + long[-1]
            seen = forward_backward(self.table[word[a:b]], begin - a, long, self.crf.first, self.crf.move)[0]
            best[a:b] = seen.argmax(1)
            np.add.at(total, owner[i : i + step], summed(seen, long))
        return total, best, sizes

    def numbers(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, and how many words each text has."""
        if len(self) * len(self.crf.langs) > CACHE:
            self.reset()
        numbers = [np.fromiter(map(self.__getitem__, found), np.int64, len(found)) for found in map(words, batch)]
        if self.pending:
            features, counts = word_features(self.pending)
            self.table = np.concatenate((self.table, summed(self.crf.weights[features].astype(np.float64), counts)))
            self.pending = []
        return np.concatenate(numbers), np.array([len(n) for n in numbers])


def spread(found: list[str], most: int) -> list[str]:
    """At most ``most`` words (a segment at least) of a document, in whole segments at even distances."""
    if len(found) <= most:
        return found
    total, some = -(-len(found) // SEGMENT), max(1, most // SEGMENT)
    # the last segment may be short, so some of the others lie before it
    begins = [i * total // some * SEGMENT for i in range(some)]
    return [w for b in begins for w in found[b : b + SEGMENT]]


def train(docs: DataFrame, lang_col: str = "lang") -> Crf | None:
    """A field fitted in one task on the bounded sample; none if there is nothing to learn."""
    seen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(lang_col).alias("lang"))
    seen = seen.where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    most = seen.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS)
    total = {r.lang: r["count"] for r in most.collect()}
    if not total:
        return None
    langs = sorted(total)
    part = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for lang, n in total.items() for x in (lang, 1 + int(1_000_000 * min(1.0, FIT / n)))])
    sample = seen.where(F.col("lang").isin(langs) & (part < share[F.col("lang")])).select(F.xxhash64("doc_id", F.lit("order")).alias("place"), "lang", "text")
    own = max(SEGMENT, min(FIT_WORDS, FIT_CELLS // len(langs)) // len(langs))
    most = max(SEGMENT, own // FIT_PARTS)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, room = [], dict.fromkeys(langs, own)
        for whole in batches:
            for batch in slices(whole):
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    # what is left of a share, if less than a segment, takes one more
                    found = spread(words(text), min(most, max(room[lang], SEGMENT))) if room[lang] > 0 else []
                    if found:
                        rows.append((found, langs.index(lang)))
                        room[lang] -= len(found)
        data = [Crf.fit(langs, rows).pack()] if rows else []
        yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["data"])

    model = sample.repartition(1).sortWithinPartitions("place", "text").mapInArrow(learn, "data binary").collect()
    return Crf.unpack(langs, bytes(model[0].data)) if model else None


def identify(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """``doc_id, lang_pred, score, n_words, n_switches`` of every document."""
    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if crf is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_switches"))
    shared = docs.sparkSession.sparkContext.broadcast((crf.langs, crf.pack()))
    names = ["doc_id", "lang_pred", "score", "n_words", "n_switches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value[1])
        if key not in _state:
            _state.clear()
            _state[key] = Scores(Crf.unpack(*shared.value))
        langs = [*shared.value[0], UNKNOWN]
        for whole in batches:
            for batch in slices(whole):
                sums, word, sizes = _state[key].judge(batch.column("text").to_pylist())
                some = sizes > 0
                best, score, switches = np.full(len(sizes), len(langs) - 1), np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
                if some.any():
                    mean = sums[some] / sizes[some][:, None]
                    best[some], score[some] = mean.argmax(1), np.minimum(mean.max(1), 1.0)
                    change = np.append(0, word[1:] != word[:-1])
                    change[(np.cumsum(sizes) - sizes)[some]] = 0
                    switches[some] = summed(change, sizes[some])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([langs[b] for b in best], pa.string()), pa.array(score), pa.array(sizes.astype(np.int64)),
                     pa.array(switches)], names)

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_words bigint, n_switches bigint")
