"""Passages that occur more than once, by bucket-pointer refinement of a sparse suffix array.

The suffixes that are sorted are those at anchors: of every ``SPAN`` bytes, the place of the ``GRAM``-byte
gram with the smallest hash (the leftmost of equals).  Equal strings of ``SPAN`` bytes have their anchor at the same
place, so each of the strings belongs to one anchor, and it can only be equal to strings of anchors with the same gram.
The method is:

1. Initial buckets are the grams of all anchors.  A bucket with one member is sorted: its strings occur once.
2. The strings of one anchor form a region of text.  Where all members of a bucket have the same region, all its
   strings occur again.  The members of the other buckets are refined by their text, each distinct region once:
   positions are bucketed by their first bytes, and buckets are refined by sorting on the bucket
   of a later offset; every round uses the buckets that the last one refined, so their depth doubles until it is ``SPAN``.
   Positions alone in their bucket drop out.
3. A bucket of more than ``CROWD`` distinct regions is too large for one task.  Its members are dealt anew, by
   buckets of the bytes at later and earlier offsets: first those that a quarter of its strings share, then a sixteenth, until
   the rest is small or one string is left.  Equal parts are merged on the way with their number, so no copies are compared.

Regions are told apart by 128 bits of hash before their bytes are compared; distinct texts by 128 bits of SHA-256.

Every row and whole text is read, text as UTF-8 bytes.  A null text is empty.  Rows that repeat, and different rows
with equal texts, are occurrences of their own.  Overlapping occurrences count.  Null ids stay.  Texts shorter than ``SPAN``
bytes lose nothing.  Other columns are left out.  An empty table gives an empty result.  A longer text is worked on in
pieces of ``PIECE`` bytes that overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cveflow.llm.arrow import offsets, ranges, slices, utf8
from cveflow.llm.frames import attach, texts
from cveflow.llm.shingles import mix
from cveflow.scratch import stored

SPAN = 400
GRAM = 100
#: Distinct regions of a bucket that one task refines.
CROWD = 4096
#: Parts a larger bucket is dealt into at a time.
PARTS = 4
#: Regions of a task, about.
REGIONS = 4096
#: Bytes of text worked on at once; a worker's arrays take about 90 times that, or 42 bytes for each byte of a larger bucket.
PIECE = 1 << 18

_PLACE = np.uint64((1 << 24) - 1)
_CODES = np.random.default_rng(31).integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASES = (0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class _Hash:
    """Hashes of any part of some bytes from sums over its prefixes."""

    def __init__(self, data: np.ndarray, which: int):
        base = _BASES[which]
        if which not in _powers or len(_powers[which][0]) <= len(data):
            n = max(len(data), PIECE + SPAN) + 1
            _powers[which] = tuple(
                np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64)))) for b in (base, pow(base, -1, 1 << 64)))
        up, self.down = _powers[which]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODES[which][data] * up[: len(data)])))

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        """Of the ``n`` bytes from every place on."""
        count = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:-n]) * self.down[:count]) if count > 0 else np.zeros(0, np.uint64)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` keys from each place on."""
    rows = -(-len(keys) // width) + 1
    padded = np.full(rows * width, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    table = padded.reshape(rows, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = max(len(keys) - width + 1, 0)
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, at: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """``text, low, high, place, bucket, region`` of every anchor of the texts in ``data``.

    The strings that start from ``low`` to ``high`` have their anchor at ``place``; all places count from the start of ``data``.
    """
    sizes = np.maximum(np.diff(at) - span + 1, 0)
    start = ranges(at[:-1], sizes)
    if not len(start):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    hashed = _Hash(data, 0).grams(gram)
    least = _least((hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64), span - gram + 1)
    place = (least[start] & _PLACE).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    low, high = start[first], start[np.append(first[1:], len(start)) - 1]
    text = np.searchsorted(at, low, "right") - 1
    region = _Hash(data, 1).of(low, high + span)
    return text, low, high, place[first], hashed[place[first]].view(np.int64), region.view(np.int64)


def _pieces(batch: pa.RecordBatch, span: int, names: tuple[str, ...] = ("text",)) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, offset, data, at`` of parts of a batch; of a long text, pieces from ``offset`` on whose strings don't repeat."""
    data, at = utf8(batch.column(batch.schema.get_field_index(names[0])))
    row = 0
    while row < batch.num_rows:
        if at[row + 1] - at[row] > PIECE:
            for begin in range(0, int(at[row + 1] - at[row]) - span + 1, PIECE):
                part = data[at[row] + begin : min(at[row] + begin + PIECE + span - 1, at[row + 1])]
                yield row, begin, part, np.array([0, len(part)])
            row += 1
        else:
            to = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
            yield row, 0, data[at[row] : at[to]], at[row : to + 1] - at[row]
            row = to


def _take(column: pa.Array, rows: np.ndarray) -> pa.Array:
    return column.take(pa.array(rows))


ANCHORS = "key binary, low bigint, high bigint, bucket bigint, region bigint"


def _anchor_rows(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offset, data, at in _pieces(batch, span):
                text, low, high, _, bucket, region = anchors(data, at, span, gram)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [_take(batch.column(0), row + text), *map(pa.array, (low - at[text] + offset, high - at[text] + offset, bucket, region))],
                        names=["key", "low", "high", "bucket", "region"])
    return run


#: ``near`` to ``far``: how far before their anchor the strings of the bucket start; ``place``: that of the anchor in ``body``.
ITEMS = "bucket bigint, region bigint, weight bigint, near int, far int, place int, body binary"


def _bodies(span: int, gram: int):
    """Text of each wanted region, once."""
    step = max(1, PIECE // (2 * span - gram))  # a region is no longer than that

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(0))
            wanted = batch.column(1)
            edge = offsets(wanted)
            flat = wanted.values.slice(edge[0], edge[-1] - edge[0])
            low, high, bucket, region, weight = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(5))
            begin = np.repeat(at[:-1], np.diff(edge)) + low
            size = high - low + span
            for to in range(0, len(begin), step):
                part = slice(to, to + step)
                body, n = data[ranges(begin[part], size[part])], len(begin[part])
                edges = np.concatenate(([0], np.cumsum(size[part])))
                hashed = _Hash(body, 0).grams(gram)
                keys = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64)
                place = (_least(keys, span - gram + 1)[edges[:-1]] & _PLACE).astype(np.int64) - edges[:-1]
                yield _items(bucket[part], region[part], weight[part], np.zeros(n, int), np.full(n, span - gram), place, body, edges)
    return run


def _binary(body: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])


def _items(bucket, region, weight, near, far, place, body, edges, more: tuple = ()) -> pa.RecordBatch:
    columns = [*(pa.array(x.astype(np.int64)) for x in more), *(pa.array(x.astype(np.int64)) for x in (bucket, region, weight)),
               *(pa.array(x.astype(np.int32)) for x in (near, far, place)), _binary(body, edges)]
    names = ["bucket", "region", "weight", "near", "far", "place", "body"]
    return pa.RecordBatch.from_arrays(columns, names=["from_bucket", "from_region", "from_string"][: len(more)] + names)


def _dealt(span: int):
    """Each item as ``PARTS`` items, by how far before the anchor its strings start.

    The new bucket is that of the bytes all strings of the part share, so longer than the old one's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "body", PIECE)):
            bucket, region, weight, near, far, place = (batch.column(k).to_numpy().astype(np.int64) for k in range(6))
            data, at = utf8(batch.column(6))
            hashes = _Hash(data, 0), _Hash(data, 1)
            last = place - (np.diff(at) - span)  # the string nearest to the anchor
            for part in range(PARTS):
                low = near + (far - near + 1) * part // PARTS
                high = near + (far - near + 1) * (part + 1) // PARTS - 1
                # strings of this part that the item has
                short, long = np.maximum(low, last), np.minimum(high, place)
                some = np.flatnonzero((short <= long) & (low <= high))
                if not len(some):
                    continue
                begin = at[:-1][some] + place[some] - long[some]
                size = long[some] - short[some] + span
                shared = at[:-1][some] + place[some] - low[some], at[:-1][some] + place[some] - high[some] + span
                key = mix(hashes[0].of(*shared) + mix(low[some].astype(np.uint64) * np.uint64(span) + high[some].astype(np.uint64)))
                same = hashes[1].of(begin, begin + size)
                edges = np.concatenate(([0], np.cumsum(size)))
                yield _items(
                    key.view(np.int64), same.view(np.int64), weight[some], low[some], high[some], long[some], data[ranges(begin, size)], edges,
                    (bucket[some], region[some], place[some] - long[some]))
    return run


def repeated(data: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Whether the string of ``span`` bytes from each place on occurs at another place, too; strings end with their text.

    ``bucket`` holds the bucket of every place by the first ``depth`` bytes, -1 where it is alone in it.
    """
    limit = np.repeat(at[1:].astype(np.int32), np.diff(at))
    depth = min(8, span)
    places = np.flatnonzero(np.arange(depth, len(data) + depth, dtype=np.int32) <= limit).astype(np.int32)
    bucket, places = _sorted(_codes(data, depth)[places], places, len(data))
    while depth < span and len(places):
        step = min(depth, span - depth)
        places = places[places + (step + depth) <= limit[places]]
        places = places[bucket[places + step] >= 0]
        bucket, places = _sorted((bucket[places].astype(np.int64) << 32) | bucket[places + step], places, len(data))
        depth += step
    return bucket >= 0


def _codes(data: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` bytes from each place on as a number."""
    code = np.zeros(max(len(data) - depth + 1, 0), np.uint64)
    for k in range(depth):
        code <<= np.uint64(8)
        code |= data[k : k + len(code)]
    return code


def _sorted(keys: np.ndarray, places: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of equal keys with two places or more, numbered in order, and those places."""
    bucket = np.full(total, -1, np.int32)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.ones(len(keys) + 1, bool)
    first[1:-1] = keys[1:] != keys[:-1]
    del keys
    shared = ~(first[:-1] & first[1:])
    bucket[places[order[shared]]] = np.cumsum(first[:-1], dtype=np.int32)[shared]
    return bucket, places[bucket[places] >= 0]


STRINGS = "bucket bigint, region bigint, low bigint, high bigint"


def _refined(span: int):
    """Strings that occur again, as ranges of places in their region; rows come sorted by bucket."""

    def solve(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = utf8(batch.column(3))
        again = repeated(data, at, span)
        heavy = batch.column(2).to_numpy() > 1
        starts = ranges(at[:-1][heavy], np.diff(at)[heavy] - span + 1)
        again[starts] = True
        place = np.flatnonzero(again)
        text = np.searchsorted(at, place, "right") - 1
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1] + 1) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        low = place[first]
        high = place[np.append(first[1:], len(place)) - 1] if len(place) else place
        text = text[first]
        rows = [_take(batch.column(k), text) for k in range(2)]
        return pa.RecordBatch.from_arrays([*rows, pa.array(low - at[text]), pa.array(high - at[text])], names=["bucket", "region", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            while batch.num_rows:
                _, at = utf8(batch.column(3))
                bucket = batch.column(0).to_numpy()
                if kept and size > PIECE:
                    # go on to the end of the bucket
                    last = kept[-1].column(0)[-1].as_py()
                    to = int(np.argmax(bucket != last)) if (bucket != last).any() else len(bucket)
                    if to:
                        kept.append(batch.slice(0, to))
                    batch = batch.slice(to)
                    if batch.num_rows:
                        yield solve(_joined(kept))
                        kept, size = [], 0
                    continue
                to = max(1, int(np.searchsorted(at, PIECE - size, "right")) - 1)
                kept.append(batch.slice(0, to))
                size += int(at[min(to, batch.num_rows)])
                batch = batch.slice(to)
        if kept:
            yield solve(_joined(kept))
    return run


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _strings(items: DataFrame, span: int, crowd: int) -> DataFrame:
    """``bucket, region, low, high``: the strings of each item that occur again.  ``items`` is stored, one row per bucket and region."""
    sizes = stored(items.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("weight").alias("all")).withColumn("members", F.col("n")), "sizes")
    total = items.count()
    sized = attach(items, sizes.where("all > 1").select("bucket", "n", "members"), ["bucket"], total)
    small = sized.where(F.col("members") <= crowd).select("bucket", "region", "weight", "body")
    found = stored(small.repartition(total // REGIONS + 1, "bucket").sortWithinPartitions("bucket").mapInArrow(_refined(span), STRINGS), "strings")
    if sizes.where(F.col("members") > crowd).isEmpty():
        return found
    origin = ["from_bucket", "from_region", "from_string"]
    crowded = sized.where(F.col("members") > crowd).select(*items.columns)
    dealt = stored(crowded.mapInArrow(_dealt(span), "from_bucket bigint, from_region bigint, from_string bigint, " + ITEMS), "dealt")
    merged = dealt.groupBy("bucket", "region").agg(
        F.count("*").alias("n"), F.sum("weight").alias("weight"), *(F.first(c).alias(c) for c in ("near", "far", "place", "body")))
    merged = stored(merged, "merged")
    parts = _strings(merged.drop("n"), span, crowd)
    lists = parts.groupBy("bucket", "region").agg(F.collect_list(F.struct("low", "high")).alias("strings"))
    lists = merged.select("bucket", "region", "n").join(lists, ["bucket", "region"])
    back = attach(dealt.select("bucket", "region", *origin), stored(lists, "lists"), ["bucket", "region"], dealt.count())
    back = back.select(*origin, F.explode("strings").alias("s")).select(
        F.col("from_bucket").alias("bucket"), F.col("from_region").alias("region"),
        (F.col("s.low") + F.col("from_string")).alias("low"), (F.col("s.high") + F.col("from_string")).alias("high"))
    return stored(found.unionByName(back), "strings")


SPANS = "array<struct<start:bigint,end:bigint>>"


def _cut(span: int):
    """What is left of each text, and what is not; rows are ``doc_id, text, copied, strings``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            data, at = utf8(batch.column(1))
            edge = offsets(batch.column(3))
            flat = batch.column(3).values.slice(edge[0], edge[-1] - edge[0])
            low, high = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            edge = edge - edge[0]
            kept, begins, ends, count = [], [], [], [0]
            for i, copied in enumerate(batch.column(2).to_pylist()):
                text = data[at[i] : at[i + 1]].tobytes()
                a, b = low[edge[i] : edge[i + 1]], high[edge[i] : edge[i + 1]] + span
                if copied and len(text) >= span:
                    a, b = np.array([0]), np.array([len(text)])
                order = np.argsort(a)
                a, b = a[order], np.maximum.accumulate(b[order])
                first = np.ones(len(a), bool)
                first[1:] = a[1:] > b[:-1]
                begin = a[first].tolist()
                end = b[np.append(np.flatnonzero(first)[1:], len(a)) - 1].tolist() if len(a) else []
                kept.append(b"".join(text[x:y] for x, y in zip([0, *end], [*begin, len(text)])))
                begins += begin
                ends += end
                count.append(len(begins))
            runs = pa.StructArray.from_arrays([pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], names=["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(count, pa.int32()), runs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), spans], names=["doc_id", "kept", "spans"])
    return run


def cut_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``doc_id, kept, spans``: the bytes that are left of every document, and the runs of bytes ``[start, end)`` that are not.

    A byte goes if a string of ``span`` bytes that covers it starts anywhere else, too.  Spans are maximal and in order.
    ``kept`` may begin or end a part within a character, as strings of bytes do.
    """
    keyed = texts(docs).withColumn("key", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    rows = stored(keyed.select("key", "text").where(F.octet_length("text") >= span).mapInArrow(_anchor_rows(span, gram), ANCHORS), "anchors")
    buckets = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), (F.min("region") < F.max("region")).alias("mixed")).where("n > 1")
    shared = stored(attach(rows, stored(buckets, "buckets"), ["bucket"], rows.count()), "shared")
    # equal texts count once each as places of a region, but with their number
    mixed = shared.where("mixed")
    places = stored(mixed.groupBy("bucket", "region").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "low", "high")).alias("p")), "places")
    whole = keyed.groupBy("key").agg(F.first("text").alias("text"))
    wanted = places.groupBy(F.col("p.key").alias("key")).agg(
        F.collect_list(F.struct("p.low", "p.high", "bucket", "region", F.col("n").alias("weight"))).alias("wanted"))
    items = stored(whole.join(wanted, "key").select("text", "wanted").mapInArrow(_bodies(span, gram), ITEMS), "items")
    strings = _strings(items, span, crowd)
    lists = strings.groupBy("bucket", "region").agg(F.collect_list(F.struct("low", "high")).alias("strings"))
    lists = stored(places.select("bucket", "region", "n").join(lists, ["bucket", "region"]), "lists")
    back = attach(mixed.select("key", "low", "bucket", "region"), lists, ["bucket", "region"], mixed.count())
    back = back.select("key", F.col("low").alias("base"), F.explode("strings").alias("s")).select(
        "key", (F.col("base") + F.col("s.low")).alias("low"), (F.col("base") + F.col("s.high")).alias("high"))
    spans = shared.where("not mixed").select("key", "low", "high").unionByName(back)
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("strings"))
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    # copies of a text go whole, so their strings need not travel
    named = keyed.groupBy("key").agg(F.count("*").alias("n")).join(spans, "key", "left").select(
        "key", "n", (F.col("n") > 1).alias("copied"), F.when(F.col("n") == 1, F.coalesce("strings", none)).otherwise(none).alias("strings"))
    found = attach(keyed, stored(named, "named"), ["key"], keyed.count()).select("doc_id", "text", "copied", "strings")
    return found.mapInArrow(_cut(span), f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, kept binary, spans {SPANS}")


def digests(cut: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of what ``cut_repeats`` gives."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", (F.octet_length("kept") + removed).alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """The digests of ``cut_repeats``."""
    return digests(cut_repeats(docs, span, gram, crowd))
