"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

1.  Every whole text becomes its set of word shingles.  Rows with the same set are one class, which has a number of its own.
2.  Bands of ``ROWS`` minima put classes into buckets; there are as many bands as keep the
    chance of missing a pair at the threshold below ``MISS``.
3.  Each member of a bucket is compared with the bucket's pivot, and the best partner of each class is verified on
    the full sets.  Members with the same verified partner are one cluster.
4.  Buckets whose members are in different clusters are compared pair by pair, in blocks of about ``BLOCK`` members, so
    a large bucket is spread over many tasks; pairs within a cluster are passed over.  A pair can't share more
    shingles than either has in common with any other open class.  Signatures are compared batch after batch: with m of n
    values equal the similarity has a Beta posterior, and a pair goes once the chance that it reaches the threshold is
    below ``MISS``.  The best pair of each cluster is verified, which joins nearly all that belong together.
5.  What is still apart is compared in the same way once more.  Members with a surviving pair take their full sets into the
    blocks, once for each block, and every surviving pair is verified there, unless links found before have joined it.
6.  The links of 3, 4 and 5 make the components.

Pairs in one component that are not compared can't change it, so no link between components is lost.  Pairs are never
rows of a table: no step gives more links than it has members.

Nulls: a document without text or words is linked with nothing; so is one whose id is null (its
``component_id`` is null and it is kept).  Repeated rows are copies of one class.  Rows that share an id but not their
text are rows of their own: each is linked by its own text.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cveflow.llm import shingles
from cveflow.llm.arrow import offsets, ranges, slices, utf8
from cveflow.llm.components import components
from cveflow.llm.frames import attach, texts
from cveflow.scratch import stored

THRESHOLD = 0.8
#: Chance that banding misses a pair at the threshold, and that pruning drops one.
MISS = 1e-5
ROWS = 4
#: Values of a signature, compared in batches of so many; each value is kept as one byte.
SIGNATURE = 256
BATCH = 64
#: Most members of a block of a bucket, and most shingles, about, of a block whose sets are compared.
BLOCK = 4096
ITEMS = 1 << 21
#: Pairs that a task compares at once.
PAIRS = 1 << 16


def bands(threshold: float) -> int:
    """Bands that miss a pair at the threshold with a chance of at most MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


@cache
def least_matches(threshold: float) -> list[int]:
    """For each batch end, the fewest equal values with which a pair may still reach the threshold.

    Values agree with chance J + (1 - J) / 256, as they are bytes.  The prior of that chance is uniform, so after m of n
    equal values the posterior of reaching the threshold is a Beta tail, computed here as a binomial one.
    """
    p = threshold + (1 - threshold) / 256

    def tail(m: int, n: int) -> float:
        # P(Beta(m + 1, n - m + 1) >= p) = P(Binomial(n + 1, p) <= m)
        logs = [math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k) + k * math.log(p) + (n + 1 - k) * math.log1p(-p)
                for k in range(m + 1)]
        return math.fsum(map(math.exp, logs))

    return [next(m for m in range(n + 1) if tail(m, n) >= MISS) for n in range(BATCH, SIGNATURE + 1, BATCH)]


def survivors(one: np.ndarray, two: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of signatures (rows) that may reach the threshold, and their equal values."""
    place, equal = np.arange(len(one)), np.zeros(len(one), np.int64)
    for end, least in zip(range(BATCH, SIGNATURE + 1, BATCH), least_matches(threshold)):
        part = slice(end - BATCH, end)
        equal += (one[:, part] == two[:, part]).sum(1)
        stay = equal >= least
        if not stay.all():
            place, equal, one, two = place[stay], equal[stay], one[stay], two[stay]
    return place, equal


def _bytes(column: pa.Array, width: int, kind=np.uint8) -> np.ndarray:
    """A binary column of equal sizes as rows of an array."""
    if not len(column):
        return np.zeros((0, width), kind)
    at = offsets(column)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(len(column), -1).view(kind)


def _band_keys(minima: np.ndarray, n_bands: int) -> np.ndarray:
    """A 64-bit key of every band of every set."""
    keys = np.repeat(np.arange(n_bands, dtype=np.uint64)[None], len(minima), 0)
    for k in range(ROWS):
        keys = shingles.mix(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, k : ROWS * n_bands : ROWS])
    return keys.view(np.int64)


def _features(docs: DataFrame, n_bands: int, carry: Sequence[str]) -> DataFrame:
    """``doc_id, n_shingles``, two fingerprints of the set, the band keys (none for an empty set) and the columns ``carry``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                hashes, at = shingles.sets(*utf8(batch.column("text")))
                sizes, (one, two) = np.diff(at), shingles.fingerprints(hashes, at)
                keys = _band_keys(shingles.minima(hashes, at, ROWS * n_bands), n_bands)
                bounds = np.concatenate(([0], np.cumsum(np.where(sizes > 0, n_bands, 0))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes), pa.array(one), pa.array(two),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(keys.ravel())), *(batch.column(c) for c in carry)],
                    ["doc_id", "n_shingles", "f1", "f2", "bands", *carry])

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>{more}")


def _profiles(docs: DataFrame, n_bands: int) -> DataFrame:
    """``doc_id``, fingerprints, signature, shortened band keys and full set of every document with words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                hashes, at = shingles.sets(*utf8(batch.column("text")))
                full = np.diff(at) > 0
                one, two = shingles.fingerprints(hashes, at)
                minima = shingles.minima(hashes, at, SIGNATURE)
                keys = _band_keys(minima, n_bands).astype(np.int32)
                bounds = np.append(0, np.cumsum(np.diff(at)[full])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").filter(pa.array(full)), pa.array(one[full]), pa.array(two[full]),
                     pa.array([r.tobytes() for r in minima.astype(np.uint8)], pa.binary()),
                     pa.array([r.tobytes() for r in keys], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes.view(np.int64)))],
                    ["doc_id", "f1", "f2", "signature", "short_keys", "hashes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, f1 bigint, f2 bigint, signature binary, short_keys binary, hashes array<bigint>")


def _likely(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Rows of ``u, v`` whose signatures may reach the threshold, with the ``equal`` values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (_bytes(batch.column(c), SIGNATURE) for c in ("su", "sv"))
            place, equal = survivors(one, two, threshold)
            kept = batch.take(pa.array(place))
            yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v"), pa.array(equal)], ["u", "v", "equal"])

    joined = pairs.join(signatures.select(F.col("node").alias("u"), F.col("signature").alias("su")), "u").join(
        signatures.select(F.col("node").alias("v"), F.col("signature").alias("sv")), "v")
    kind = joined.schema["u"].dataType.simpleString()
    return joined.select("u", "v", "su", "sv").mapInArrow(run, f"u {kind}, v {kind}, equal bigint")


def _verified(pairs: DataFrame, profiles: DataFrame, threshold: float) -> DataFrame:
    """Rows of ``u, v`` whose full sets reach the threshold."""
    percent = round(100 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(np.asarray(c.values), offsets(c)) for c in (batch.column("hu"), batch.column("hv"))]
            keep = []
            for i in range(batch.num_rows):
                one, two = (values[at[i] : at[i + 1]] for values, at in sets)
                merged = np.concatenate((one, two))
                merged.sort(kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * common >= percent * (len(merged) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("u", "v").join(profiles.select(F.col("node").alias("u"), F.col("hashes").alias("hu")), "u").join(
        profiles.select(F.col("node").alias("v"), F.col("hashes").alias("hv")), "v")
    kind = joined.schema["u"].dataType.simpleString()
    return joined.select("u", "v", "hu", "hv").mapInArrow(run, f"u {kind}, v {kind}")


def _best(found: list[np.ndarray]) -> list[np.ndarray]:
    """Of the columns ``u, v, ru, rv, equal`` for each cluster the row with the most equal values: no more rows than clusters."""
    row, cluster = np.tile(np.arange(len(found[0])), 2), np.concatenate(found[2:4])
    order = np.lexsort((row, -found[4][row], cluster))
    first = np.ones(len(order), bool)
    first[1:] = cluster[order][1:] != cluster[order][:-1]
    kept = np.unique(row[order][first])
    return [c[kept] for c in found]


class _Verifier:
    """Exact comparison of the sets of a batch; clusters that a link joins are one from then on."""

    def __init__(self, hashes: pa.Array, root: np.ndarray, percent: int):
        self.at = offsets(hashes) - offsets(hashes)[0]
        values = np.asarray(hashes.values)[offsets(hashes)[0] : offsets(hashes)[-1]]
        # shingles as small numbers, so that a set is a table of flags
        vocabulary, self.codes = np.unique(values, return_inverse=True)
        self.flags = np.zeros(len(vocabulary), bool)
        self.size, self.label, self.percent = np.diff(self.at), root, percent

    def links(self, one: np.ndarray, two: np.ndarray, equal: np.ndarray) -> list[tuple[int, int]]:
        """Of the pairs (``one`` ascending) as many that reach the threshold as join all they can join."""
        out = []
        bounds = np.flatnonzero(np.append(True, one[1:] != one[:-1])) if len(one) else []
        for first, last in zip(bounds, [*bounds[1:], len(one)]):
            u, others = int(one[first]), two[first:last][np.argsort(-equal[first:last], kind="stable")]
            own, step = self.codes[self.at[u] : self.at[u + 1]], 16
            self.flags[own] = True
            while True:
                others = others[self.label[others] != self.label[u]]
                if not len(others):
                    break
                some, others = others[:step], others[step:]
                step = min(4 * step, PAIRS >> 4)
                sizes = self.size[some]
                held = self.flags[self.codes[ranges(self.at[some], sizes)]]
                common = np.add.reduceat(held.astype(np.int64), np.cumsum(sizes) - sizes)
                near = some[100 * common >= self.percent * (self.size[u] + sizes - common)]
                joined, place = np.unique(self.label[near], return_index=True)
                out += [(u, int(v)) for v in near[place]]
                if len(joined):
                    self.label[np.isin(self.label, joined)] = self.label[u]
            self.flags[own] = False
        return out


def _block_pairs(members: DataFrame, n_bands: int, threshold: float, step: str) -> DataFrame:
    """Compares members of different clusters of each bucket, a pair in the first band it shares.

    ``members``: ``key, blocks, node, root, signature, short_keys, size, common``.  Each member is shipped once for every
    block of its bucket.  Steps, none of which gives more rows than members:

    - ``best``: for each cluster of a block the likeliest pair ``u, v`` of clusters ``ru, rv``.
    - ``flag``: the members ``key, node, root, size`` that have any likely partner.
    - ``verify``: with ``hashes``, pairs ``u, v`` that reach the threshold and join all clusters of a block that can be joined.
    """
    percent = round(100 * threshold)
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("second"),
        (F.col("own") == F.col("other")).alias("alone"), "node", "root", "signature", "short_keys", "size", "common",
        *(["hashes"] if step == "verify" else []))
    group = ["key", "low", "high"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group, "second", "node")
    kind = members.schema["node"].dataType.simpleString()

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        """One or more whole groups: pairs inside a block, or between the two blocks of a group."""
        names = [np.asarray(batch.column(c)) for c in group]
        signature = _bytes(batch.column("signature"), SIGNATURE)
        short = _bytes(batch.column("short_keys"), 4 * n_bands, np.int32)
        root, alone = np.array(batch.column("root")), np.asarray(batch.column("alone"))
        second, size_of, common = (np.asarray(batch.column(c)) for c in ("second", "size", "common"))
        n = batch.num_rows
        new = np.ones(n, bool)
        new[1:] = (names[0][1:] != names[0][:-1]) | (names[1][1:] != names[1][:-1]) | (names[2][1:] != names[2][:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, n))
        end = np.repeat(start + size, size)
        middle = np.repeat(end[start] - np.add.reduceat(second.astype(np.int64), start), size)
        first = np.where(alone, np.arange(n) + 1, middle)
        partners = np.where(second, 0, np.maximum(end - first, 0))
        found, flagged, links = [np.zeros((5, 0), np.int64)], np.zeros(n, bool), []
        verifier = None
        ends = np.cumsum(partners)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            one = np.repeat(np.arange(at, to), partners[at:to])
            two = ranges(first[at:to], partners[at:to])
            most = np.minimum(common[one], common[two])
            open_ = (root[one] != root[two]) & (100 * most >= percent * (size_of[one] + size_of[two] - most))
            one, two = one[open_], two[open_]
            place, equal = survivors(signature[one], signature[two], threshold)
            one, two = one[place], two[place]
            if len(one):
                # the first band in which the two agree reports the pair
                band = (short[one] == short[two]).argmax(1)
                here = short[one, band] == names[0][one].astype(np.int32)
                one, two, equal = one[here], two[here], equal[here]
                if step == "best":
                    found.append(np.stack(_best([one, two, root[one], root[two], equal])))
                elif step == "flag":
                    flagged[one] = flagged[two] = True
                elif len(one):
                    # ``root`` follows the links found so far
                    verifier = verifier or _Verifier(batch.column("hashes"), root, percent)
                    links += verifier.links(one, two, equal)
            at = to
        node = batch.column("node")
        if step == "flag":
            return batch.select(["key", "node", "root", "size"]).filter(pa.array(flagged))
        if step == "verify":
            u, v = np.array(links, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([node.take(pa.array(u)), node.take(pa.array(v))], ["u", "v"])
        u, v, ru, rv, equal = _best(list(np.concatenate(found, 1)))
        return pa.RecordBatch.from_arrays(
            [node.take(pa.array(u)), node.take(pa.array(v)), pa.array(ru), pa.array(rv), pa.array(equal)], ["u", "v", "ru", "rv", "equal"])

    def whole_groups(rest: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(rest).combine_chunks().to_batches(max_chunksize=None)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            for part in (batch.slice(i, BLOCK) for i in range(0, batch.num_rows, BLOCK)):
                keys = [np.asarray(part.column(c)) for c in group]
                last = (keys[0] == keys[0][-1]) & (keys[1] == keys[1][-1]) & (keys[2] == keys[2][-1])
                cut = int(np.argmax(last))
                if cut == 0 and rest and all(rest[-1].column(c)[-1].as_py() == part.column(c)[0].as_py() for c in group):
                    rest.append(part)
                    continue
                whole = [*rest, part.slice(0, cut)] if cut else rest
                if whole:
                    yield compare(whole_groups(whole))
                rest = [part.slice(cut)]
        if rest:
            yield compare(whole_groups(rest))

    schema = {"best": f"u {kind}, v {kind}, ru bigint, rv bigint, equal bigint", "flag": f"key bigint, node {kind}, root bigint, size bigint",
              "verify": f"u {kind}, v {kind}"}
    return dealt.mapInArrow(run, schema[step])


def _open(members: DataFrame, roots: DataFrame, profiles: DataFrame, threshold: float) -> DataFrame:
    """Members of buckets that hold several clusters, with all that a comparison of signatures needs."""
    rooted = stored(members.join(roots, "node", "left").select(
        "key", "node", F.col("size").alias("n"), F.coalesce("root", "node").alias("root")), "rooted")
    apart = rooted.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("one"), F.max("root").alias("two"))
    apart = stored(apart.where("one <> two").select("key", "n"), "apart")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    found = stored(attach(rooted.drop("n"), apart.select("key", "n", blocks), ["key"], rooted.count()), "open")
    common = _common(found.select("node").distinct(), profiles)
    able = profiles.select("node", "signature", "short_keys").join(
        common.where(F.col("common") * 100 >= F.col("size") * round(100 * threshold)), "node")
    return found.join(able, "node")


def _linked(members: DataFrame, roots: DataFrame, profiles: DataFrame, n_bands: int, threshold: float) -> DataFrame:
    """Links ``u, v`` between all that is still apart and reaches the threshold, as many as join it.

    Members without a likely partner go first; only the rest carry their full sets into the blocks, which hold at most about
    ``ITEMS`` shingles.
    """
    flagged = _block_pairs(_open(members, roots, profiles, threshold), n_bands, threshold, "flag")
    flagged = stored(flagged.distinct(), "flagged")
    blocks = F.least(F.count("*"), F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / ITEMS))).cast("int").alias("blocks")
    buckets = flagged.groupBy("key").agg(F.count("*").alias("n"), blocks)
    found = attach(flagged, stored(buckets, "flagged-buckets"), ["key"], flagged.count())
    sets = profiles.select("node", "signature", "short_keys", "hashes")
    return _block_pairs(found.withColumn("common", F.col("size")).join(sets, "node"), n_bands, threshold, "verify")


def _common(nodes: DataFrame, profiles: DataFrame) -> DataFrame:
    """``node, size, common``: shingles of each node, and how many of them any other of the nodes has."""
    own = profiles.join(nodes, "node", "left_semi")
    holders = own.select("node", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    lone = holders.where("n = 1").groupBy("node").agg(F.count("*").alias("lone"))
    size = F.size("hashes").cast("bigint")
    return own.select("node", size.alias("size")).join(lone, "node", "left").select(
        "node", "size", (F.col("size") - F.coalesce("lone", F.lit(0))).alias("common"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row, and its columns ``carry``; ``threshold`` in whole percents."""
    n_bands, text = bands(threshold), texts(docs)
    found = stored(_features(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *carry), n_bands, carry), "features")
    linkable = found.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    fingerprint = ["n_shingles", "f1", "f2"]
    classes = linkable.groupBy(*fingerprint).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    # an id may stand for several classes, so they get numbers of their own, fixed once written
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    named = classes.select("node", "doc_id", "f1", "f2")

    # buckets of two and more representatives
    banded = linkable.join(named.hint("merge"), ["doc_id", "f1", "f2"]).select("node", F.explode("bands").alias("key")).distinct()
    banded = stored(banded, "bands")
    pivot = F.min(F.struct(F.xxhash64("node", "key").alias("order"), F.col("node").alias("pivot")))["pivot"]
    buckets = stored(banded.groupBy("key").agg(F.count("*").alias("n"), pivot.alias("pivot")).where("n > 1"), "buckets")
    members = stored(attach(banded, buckets.withColumn("size", F.col("n")), ["key"], banded.count()), "members")

    # signature and full set of their members
    needed = members.select("node").distinct().join(named, "node")
    wanted = text.join(needed.select("doc_id").distinct(), "doc_id", "left_semi")
    profiles = _profiles(wanted, n_bands).join(needed.hint("merge"), ["doc_id", "f1", "f2"]).drop("doc_id", "f1", "f2")
    profiles = stored(profiles.dropDuplicates(["node"]), "profiles")

    # the best pivot of each member
    starred = members.where("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    best = _likely(starred, profiles, threshold).groupBy("u").agg(F.max_by("v", F.struct("equal", "v")).alias("v"))
    stars = stored(_verified(best, profiles, threshold), "stars")

    # the best pair of each cluster, then all that is still apart
    pairs = _block_pairs(
        _open(members, stars.select(F.col("u").alias("node"), F.col("v").alias("root")), profiles, threshold), n_bands, threshold, "best")
    pair = pairs.select("u", "v", "equal", F.explode(F.array("ru", "rv")).alias("cluster")).groupBy("cluster").agg(
        F.max_by(F.struct("u", "v"), F.struct("equal", "u", "v")).alias("best"))
    roots = stored(components(stars.unionByName(_verified(pair.select("best.*").distinct(), profiles, threshold))), "roots")
    links = stored(_linked(members, roots, profiles, n_bands, threshold), "links")

    # links between components of the first links join those
    joined = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    links = links.join(joined, "u", "left").join(joined.select(F.col("u").alias("v"), F.col("ru").alias("rv")), "v", "left")
    later = components(links.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    later = later.select(F.col("node").alias("first"), F.col("root").alias("last"))
    labels = classes.join(roots.hint("merge"), "node", "left").withColumn("first", F.coalesce("root", "node"))
    labels = stored(labels.join(later.hint("merge"), "first", "left").select(
        *fingerprint, "n", "doc_id", F.coalesce("last", "first").alias("component")), "labels")
    least = labels.groupBy("component").agg(F.count("*").alias("n"), F.min("doc_id").alias("component_id"))
    labels = attach(labels.select(*fingerprint, F.col("n").alias("rows"), "component"), stored(least, "least"), ["component"], labels.count())
    labels = labels.select(*fingerprint, F.col("rows").alias("n"), "component_id")
    columns = ["doc_id", "n_shingles", "component_id", *carry]
    linked = attach(linkable.select("doc_id", *fingerprint, *carry), labels, fingerprint, linkable.count()).select(*columns)
    alone = found.where((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).withColumn("component_id", F.col("doc_id")).select(*columns)
    return linked.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *carry)
