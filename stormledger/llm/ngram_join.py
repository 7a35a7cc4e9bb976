"""N-gram Jaccard join by a partitioned universe.

Sets of hashed word shingles (five words) are linked at a Jaccard similarity of
``percent`` or more. Two linked sets of a and b shingles differ in at most
(a + b)(100 - percent) / (100 + percent) of them. The shingle universe is hashed
into m segments, m by size band (powers of two): a set that may differ in H
shingles and has signatures in H + 1 segments or more shares a whole segment with
any set it links to. So the index holds one signature per non-empty segment.

Allocation by cost. The smaller set of a pair probes. Segments whose signature
no other set has cost nothing: with H + 1 of them a set has no link at all and leaves the
index, which makes more signatures unshared (``_peeled``). Any other set
spends what is left of H + 1 on its rarest shared signatures. Where any set of a
band has too few non-empty segments, the first D segments of the band count twice:
there all sets also index their one-deletion neighbourhoods, which finds segments
that differ in one shingle; D is the least that gives every set H + 1.

Pairs are verified on the whole sets. In a small bucket of equal signatures all pairs
are; in a large one each set is verified against one hub only, so that a group of copies
is joined without listing its pairs. What then still lies in several components is
compared by its changes against one reference set of its bucket: an exact prefix filter over the
changes finds the pairs that can be linked, and these are verified. So no link between
two components is missed. Equal sets are one class throughout. Classes are known
by 64-bit keys.

Texts as in ``shingles``; null or wordless text: empty set, linked with nothing.
Each row is a document; a component is named by its smallest non-null doc_id, an
unlinked document by its own. Repeated rows have equal sets and share a component.
An empty table gives an empty one; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from stormledger.llm.components import components
from stormledger.llm.shingles import mix, set_key, shingle_sets
from stormledger.runtime import cut_at, drop_scratch

PERCENT = 80
COUNTER_CELLS = 1 << 16  # of the fixed-size counter that ranks changes by rarity
INDEX_ROWS = 400_000  # signatures that a task pre-aggregates together
PEELS = 1  # rounds that take signatures without a link out before pairs are looked for
SMALL_BUCKET = 32  # up to so many sets of one signature all pairs are verified
ODD_BITS = 256
MOST_BEFORE = 128  # tokens of a prefix that its rows repeat
ODD = [f"odd{k}" for k in range(ODD_BITS // 64)]
FILTER_BITS = 1 << 23  # of the fixed-size filter of wanted documents
_U = np.uint64
_I = np.int64

# may probe, and a segment that every smaller partner has too; may probe; a doubled segment's;
# only to be found, by every smaller partner of the band below; only to be found
LOW, PLAIN, NEAR, OTHER_LOW, OTHER = 0, 1, 2, 3, 4


class Layout(NamedTuple):
    """How segments are cut; any layout gives the same result."""

    percent: int = PERCENT
    spare: float = 1.1  # segments over the H + 1 that are needed, for empty and frequent ones
    small_bands: int = 4  # below 2**4 shingles a band has many segments: sets have few signatures anyway
    small_segments: int = 64


def allowed(total: int, percent: int) -> int:
    """Most shingles in which two linked sets of ``total`` together can differ."""
    return total * (100 - percent) // (100 + percent)


class Band:
    """Segments of the sets of 2**k to 2**(k + 1) - 1 shingles."""

    def __init__(self, k: int, layout: Layout, doubled: int = 0):
        self.k, self.layout, self.doubled = k, layout, doubled
        self.last = (1 << (k + 1)) - 1
        self.reach = self.last * 100 // layout.percent  # the largest set linked to one of this band
        need = self.differ(self.last) + 1
        self.segments = layout.small_segments if k < layout.small_bands else int(need * layout.spare / 0.97) + 4
        self.salt = int(mix(np.array([k + 1], _U))[0])

    def differ(self, n: int) -> int:
        return allowed(n + n * 100 // self.layout.percent, self.layout.percent)

    def used(self, n: int) -> int:
        """Segments that a set of n shingles of this band probes; grows with n."""
        if self.k < self.layout.small_bands:
            return self.segments
        empty = float(np.exp(-n / self.segments))
        need = (self.differ(n) + 1) * self.layout.spare / (1 - empty)
        return min(self.segments, int(need + 4 * np.sqrt(need * empty)) + 1)


class Scheme:
    def __init__(self, layout: Layout, doubled: dict[int, int]):
        self.layout, self.doubled, self.bands = layout, doubled, {}

    def band(self, k: int) -> Band:
        if k not in self.bands:
            self.bands[k] = Band(k, self.layout, self.doubled.get(k, 0))
        return self.bands[k]

    def places(self, n: int) -> list[tuple[Band, int, int, bool]]:
        """(band, segments used, those that any smaller partner uses too, probes) of a set of n shingles.

        Its own band, and the one below if linked sets lie there.
        """
        least = -(-n * self.layout.percent // 100)
        own = self.band(n.bit_length() - 1)
        out = [(own, own.used(n), own.used(max(least, 1 << own.k)), True)]
        if own.k and n <= (below := self.band(own.k - 1)).reach:
            out.append((below, below.segments, below.used(max(least, 1 << below.k)), False))
        return out

    def contents(self, band: Band, hashes: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Non-empty segments below ``used``, the sum of each, and shingles with their segments."""
        spread = mix(hashes ^ _U(band.salt))
        segment = ((spread >> _U(32)) * _U(band.segments)) >> _U(32)
        keep = segment < _U(used)
        spread, segment = spread[keep], segment[keep].astype(_I)
        order = np.argsort(segment, kind="stable")
        spread, segment = spread[order], segment[order]
        cuts = np.flatnonzero(np.diff(segment, prepend=-1))
        sums = np.add.reduceat(spread, cuts) if len(cuts) else np.zeros(0, _U)
        return segment[cuts], sums, spread, segment

    def profile(self, hashes: np.ndarray) -> tuple[int, int, int, int]:
        """Non-empty segments that a set probes, how many doubled ones it would need, and the
        non-empty ones that smaller partners have too, in its own band and the one below (-1: none there)."""
        n = len(hashes)
        if not n:
            return 0, 0, 0, -1
        (band, used, low, _), *lower = self.places(n)
        filled = self.contents(band, hashes, used)[0]
        below = [len(self.contents(b, hashes, u)[0]) for b, _, u, _ in lower]
        need = band.differ(n) + 1
        double = 0
        while len(filled) - np.searchsorted(filled, double) + 2 * double < need:
            double += 1
        return len(filled), double if len(filled) < need else 0, int(np.searchsorted(filled, low)), *(below or [-1])

    def signatures(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All signatures of a set and their kinds."""
        found, kinds = [], []
        for band, used, low, probes in self.places(len(hashes)):
            filled, sums, spread, segment = self.contents(band, hashes, used)
            place = mix(filled.astype(_U) + _U(band.salt))
            found.append(mix(sums + place))
            kinds.append(np.where(filled < low, *((LOW, PLAIN) if probes else (OTHER_LOW, OTHER))).astype(np.int32))
            if band.doubled:
                empty = np.setdiff1d(np.arange(band.doubled), filled)
                short = segment < band.doubled
                at = np.searchsorted(filled, segment[short])
                found += [mix(mix(empty.astype(_U) + _U(band.salt))), mix(sums[at] - spread[short] + place[at])]
                kinds.append(np.full(len(empty) + int(short.sum()), NEAR if probes else OTHER, np.int32))
        return np.concatenate(found), np.concatenate(kinds)


def _profiles(docs: DataFrame, layout: Layout) -> DataFrame:
    """(doc_id, n, key, filled, doubled, low, below) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = Scheme(layout, {})
        for batch in batches:
            rows = [(len(s), set_key(s), *scheme.profile(s)) for s in shingle_sets(batch.column(1))]
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6
            kinds = [pa.int32(), pa.int64(), *[pa.int32()] * 4]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n", "key", "filled", "doubled", "low", "below"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n int, key long, filled int, doubled int, low int, below int")


def _index(docs: DataFrame, layout: Layout, doubled: dict[int, int]) -> DataFrame:
    """(spot, sig, key, kind, copies): signatures of all sets, pre-aggregated in each task.

    Equal signatures met together leave one row for the shuffle by ``sig``, with
    their number in ``copies``; the others, with the negative number, are spread
    over all tasks by ``spot``.
    """

    def flush(found: list, keys: list, kinds: list) -> pa.RecordBatch:
        sig, key, kind = np.concatenate(found), np.concatenate(keys), np.concatenate(kinds)
        _, first, back, counts = np.unique(sig, return_index=True, return_inverse=True, return_counts=True)
        lead = np.zeros(len(sig), bool)
        lead[first] = True
        copies = np.where(lead, counts[back], -counts[back]).astype(np.int32)
        spot = np.where(lead, sig, mix(sig ^ mix(key.view(_U))))
        return pa.RecordBatch.from_arrays(
            [pa.array(spot.view(_I)), pa.array(sig.view(_I)), pa.array(key), pa.array(kind), pa.array(copies)],
            ["spot", "sig", "key", "kind", "copies"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, seen, held = Scheme(layout, doubled), set(), 0
        found, keys, kinds = [], [], []
        for batch in batches:
            for hashes in shingle_sets(batch.column(0)):
                key = set_key(hashes)
                if not key or key in seen:
                    continue
                seen.add(key)
                sig, kind = scheme.signatures(hashes)
                found.append(sig)
                keys.append(np.full(len(sig), key, _I))
                kinds.append(kind)
                held += len(sig)
                if held >= INDEX_ROWS:
                    yield flush(found, keys, kinds)
                    found, keys, kinds, held = [], [], [], 0
        if held:
            yield flush(found, keys, kinds)

    return docs.select("text").mapInArrow(run, "spot long, sig long, key long, kind int, copies int")


def _bits(ids: np.ndarray) -> list[np.ndarray]:
    spread = mix(ids.astype(_I).view(_U) + _U(1))
    return [(spread % _U(FILTER_BITS)).astype(_I), ((spread >> _U(32)) % _U(FILTER_BITS)).astype(_I)]


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit map of fixed size that holds all ids of the only column; more ids let more others pass, none is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_bits(batch.column(0).to_numpy(zero_copy_only=False))))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["place", "bits"])

    rows = ids.dropna().mapInArrow(run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).collect()
    words = np.zeros(FILTER_BITS // 32, _I)
    for place, bits in rows:
        words[place] = bits
    return words


def _sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(key, shingles) of the documents that pass the filter, each set once in a task."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = held.value, set()
        for batch in batches:
            ids = batch.column(0)
            first, second = _bits(ids.fill_null(0).to_numpy(zero_copy_only=False))
            ok = ((words[first >> 5] >> (first & 31)) & (words[second >> 5] >> (second & 31)) & 1).astype(bool)
            ok |= ids.is_null().to_numpy(zero_copy_only=False)
            keys, lists = [], []
            for hashes in shingle_sets(batch.column(1).filter(pa.array(ok))):
                key = set_key(hashes)
                if key and key not in seen:
                    seen.add(key)
                    keys.append(key)
                    lists.append(hashes.view(_I))
                if len(lists) >= 500:
                    yield _set_rows(keys, lists)
                    keys, lists = [], []
            if lists:
                yield _set_rows(keys, lists)

    return docs.select("doc_id", "text").mapInArrow(run, "key long, shingles array<long>")


def _set_rows(keys: list[int], lists: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))], ["key", "shingles"]
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
        .filter(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent)
        .select("a", "b")
    )


def _fitting(percent: int, small: str = "n", large: str = "m"):
    least, most = F.least(small, large), F.greatest(small, large)
    return least * 100 >= most * percent


def similar_sets(docs: DataFrame, layout: Layout = Layout()) -> tuple[DataFrame, DataFrame]:
    """(profiles of all documents, components of the set classes that have links).

    The second table is (node, component) over class keys.
    """
    spark, percent = docs.sparkSession, layout.percent
    profiles, _ = cut_at(_profiles(docs, layout), "ngram-profiles")
    band = F.floor(F.log2("n")).cast("int")
    doubled = {r[0]: r[1] for r in profiles.filter("doubled > 0").groupBy(band.alias("k")).agg(F.max("doubled")).collect()}
    classes = profiles.filter("n > 0").groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("n", "filled", "low", "below")], F.min("doc_id").alias("doc_id")
    )
    classes = classes.withColumn("need", F.floor((F.col("n") + F.floor(F.col("n") * 100 / percent)) * (100 - percent) / (100 + percent)) + 1)

    index = _index(docs, layout, doubled)
    # tasks repeat a class that has copies in several of them: only different keys share a signature
    bucket = W.partitionBy("spot", "sig")
    together = F.when((F.min("key").over(bucket) < F.max("key").over(bucket)) | (F.max("copies").over(bucket) > 1), F.sum("copies").over(bucket))
    shared = index.withColumn("met", F.when(F.col("copies") < 0, -F.col("copies")).otherwise(together)).filter("met > 1").dropDuplicates(["sig", "key", "kind"])
    shared, shared_path = cut_at(shared.select("sig", "key", "kind", "met"), "ngram-shared")

    known = classes.select(F.col("key").alias("k"), "n", "filled", "need")
    for _ in range(PEELS):
        shared, peeled_path = cut_at(_peeled(shared, classes.drop("doc_id"), percent), "ngram-shared")
        drop_scratch(spark, shared_path)
        shared_path = peeled_path

    # what a set still has to spend after the segments that nobody shares
    own = W.partitionBy("key")
    ranked = shared.filter(F.col("kind") <= PLAIN).withColumn("place", F.row_number().over(own.orderBy("met", "sig"))).withColumn(
        "shared", F.count("*").over(own)
    )
    cheapest = ranked.join(known, F.col("key") == F.col("k")).filter(F.col("place") <= F.col("need") - F.col("filled") + F.col("shared"))
    short = shared.filter(F.col("kind") == NEAR).join(known.filter("filled < need"), F.col("key") == F.col("k"))
    probes, probes_path = cut_at(cheapest.select("sig", "key", "n").union(short.select("sig", "key", "n")).distinct(), "ngram-probes")
    indexed = shared.join(probes.select("sig").distinct(), "sig", "left_semi").select("sig", "key").distinct()
    indexed, indexed_path = cut_at(indexed.join(known, F.col("key") == F.col("k")).select("sig", F.col("key").alias("other"), F.col("n").alias("m")), "ngram-indexed")
    drop_scratch(spark, shared_path)

    wanted = indexed.select(F.col("other").alias("key")).distinct().join(classes.select("key", "doc_id"), "key")
    sets = _sets(docs, _filter_of(wanted.select("doc_id"))).join(wanted.select("key"), "key", "left_semi")
    sets, sets_path = cut_at(sets.dropDuplicates(["key"]), "ngram-sets")

    # all pairs of small buckets, and in large ones each probing set against the bucket's hub
    sizes = indexed.groupBy("sig").agg(F.count("*").alias("size"))
    popular = indexed.join(sizes, "sig").groupBy("other").agg(F.sum("size").alias("fame"))
    hub = F.max(F.struct("fame", "other", "m")).alias("hub")
    hubs, hubs_path = cut_at(indexed.join(popular, "other").groupBy("sig").agg(F.count("*").alias("size"), hub), "ngram-hubs")
    refs, refs_path = cut_at(_references(indexed, hubs), "ngram-references")
    pairs = _small_pairs(probes, indexed, hubs, percent).union(_hub_pairs(probes, refs, percent)).distinct()
    links, links_path = cut_at(_verified(pairs, sets, percent), "ngram-links")
    parts, parts_path = cut_at(components(links), "ngram-components")

    large, large_path = cut_at(_open_members(indexed, refs, parts), "ngram-large")
    spent = [probes_path, indexed_path, sets_path, hubs_path, refs_path, links_path, large_path]
    if not large.isEmpty():
        changes, changes_path = cut_at(_changes(large, sets, percent), "ngram-changes")
        near = changes.filter("near").select(*_ordered("key", "hub"))
        drop_scratch(spark, parts_path)
        known, known_path = cut_at(components(links.union(near)), "ngram-components")
        far, far_path = cut_at(_change_pairs(changes, known, percent), "ngram-far")
        more, more_path = cut_at(_verified(far, sets, percent), "ngram-more")
        parts, _ = cut_at(components(links.union(near).union(more)), "ngram-components")
        spent += [changes_path, known_path, far_path, more_path]
    for path in spent:
        drop_scratch(spark, path)
    return profiles, parts


def _peeled(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``shared`` without the signatures through which a set can have no link, and what nobody else shares then.

    A set probes no larger one if ``need`` of its segments are shared by nobody; it is found
    by no smaller one if, of the segments that all smaller partners have too, one more is shared by
    nobody than two sets of its size may differ in. Without it, signatures of others become their own.
    """
    own = shared.groupBy(F.col("key").alias("k")).agg(*[
        F.count(F.when(F.col("kind").isin(*kinds), 1)).alias(name)
        for name, kinds in (("any", (LOW, PLAIN)), ("some", (LOW,)), ("lower", (OTHER_LOW,)))
    ])
    few = _allowed(F.col("n") * 2, percent) + 1
    here = (F.col("filled") - F.col("any") < F.col("need")) | (F.col("low") - F.col("some") < few)
    there = (F.col("below") >= 0) & (F.col("below") - F.col("lower") < few)
    role = classes.join(own, F.col("key") == F.col("k")).select("k", here.alias("here"), there.alias("there"))
    left = shared.join(role.filter("here OR there"), F.col("key") == F.col("k")).filter(
        F.when(F.col("kind") >= OTHER_LOW, F.col("there")).otherwise(F.col("here"))
    ).select("sig", "key", "kind")
    met = left.groupBy(F.col("sig").alias("s")).agg(F.count("*").cast("int").alias("met"), F.min("key").alias("least"), F.max("key").alias("most"))
    return left.join(met.filter("least < most"), F.col("sig") == F.col("s")).select("sig", "key", "kind", "met")


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _small_pairs(probes: DataFrame, indexed: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """Every pair of a probing set and another one in a bucket of at most ``SMALL_BUCKET`` sets."""
    small = hubs.filter(F.col("size") <= SMALL_BUCKET).select("sig")
    met = probes.join(small, "sig", "left_semi").join(indexed.join(small, "sig", "left_semi"), "sig")
    return met.filter("key <> other AND m >= n").filter(_fitting(percent)).select(*_ordered("key", "other"))


def _references(indexed: DataFrame, hubs: DataFrame) -> DataFrame:
    """(sig, fame, hub, hub_n) of the large buckets: one set that all sets of the bucket are compared with.

    It is the most shared set that the bucket's own most shared set meets in any large
    bucket, so that the buckets of one family have the same few references.
    """
    large = hubs.filter(F.col("size") > SMALL_BUCKET).select("sig", "hub")
    best = indexed.join(large, "sig").groupBy(F.col("other").alias("first")).agg(F.max("hub").alias("best"))
    return large.join(best, F.col("hub.other") == F.col("first")).select(
        "sig", "best.fame", F.col("best.other").alias("hub"), F.col("best.m").alias("hub_n")
    )


def _hub_pairs(probes: DataFrame, refs: DataFrame, percent: int) -> DataFrame:
    """One pair for each probing set of large buckets: with the most shared of their references."""
    met = probes.join(refs, "sig").filter("key <> hub").filter(_fitting(percent, "n", "hub_n"))
    first = met.groupBy("key").agg(F.max(F.struct("fame", "hub")).alias("best"))
    return first.select(*_ordered("key", "best.hub"))


def _open_members(indexed: DataFrame, refs: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, hub) rows of the large buckets whose sets still lie in several components."""
    found = indexed.join(refs.select("sig", "hub"), "sig").join(parts, F.col("other") == F.col("node"), "left").withColumn("c", F.coalesce("component", "other"))
    mixed = found.groupBy("sig").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("sig")
    return found.join(mixed, "sig", "left_semi").select(F.col("other").alias("key"), "hub").distinct()


def _changes(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What tells the sets of each open large bucket from its hub.

    (key, hub, n, d, near, asks, held, tokens): the shingles that only one of the two
    has, their number, whether set and hub are linked, and how many of the shingles the
    set looks up and how many it is found by.
    """
    cores = large.select("hub").distinct().join(sets, F.col("hub") == F.col("key")).select("hub", F.col("shingles").alias("core"))
    own = large.filter("key <> hub").join(sets, "key").join(cores, "hub")
    told = own.select(
        "key", "hub", F.size("shingles").alias("n"), F.size("core").alias("hub_n"),
        F.concat(F.array_except("shingles", "core"), F.array_except("core", "shingles")).alias("tokens"),
    ).withColumn("d", F.size("tokens"))
    extra = F.ceil(F.greatest(F.lit(0), F.col("n") - F.col("hub_n")) * (100 - percent) / (100 + percent))
    asks = F.least(F.col("d"), _allowed(F.col("n") + F.floor(F.col("n") * 100 / percent), percent) + 1)
    held = F.greatest(F.lit(0), F.least(asks, F.col("d") - F.ceil((F.lit(1) + F.col("d") - extra) / 2) + 1))
    near = F.col("d") <= _allowed(F.col("n") + F.col("hub_n"), percent)
    return told.select("key", "hub", "n", "d", near.alias("near"), asks.cast("int").alias("asks"), held.cast("int").alias("held"), "tokens")


def _rarest_first(changes: DataFrame) -> DataFrame:
    """(key, hub, n, d, *ODD, token, asked, found, before): the prefix of each set, rarest tokens first.

    Tokens are ranked by a counter of fixed size over the sets that look others up. Any order that all
    sets share gives the same links; a better one only fewer pairs to verify. A token that
    none of those sets has is looked up by nobody and not emitted. ``ODD`` tells of each of 256
    classes of tokens whether the set's changes hold an odd number: two sets differ in at
    least as many shingles as there are classes that tell them apart. ``before`` holds the tokens of the
    prefix before this one, by which a pair is met under its first shared token only; null in
    prefixes of more than ``MOST_BEFORE`` tokens, whose pairs are met under each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTER_CELLS, _I)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False) & (COUNTER_CELLS - 1), minlength=COUNTER_CELLS)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts[cell])], ["cell", "n"])

    far = changes.filter(~F.col("near")).select("tokens")
    counted = far.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()
    counts = np.zeros(COUNTER_CELLS, _I)
    for at, n in counted:
        counts[at] = n
    held = changes.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = held.value
        for batch in batches:
            keys, hubs, sizes, changed, near, asks, founds, lists = (batch.column(k) for k in range(8))
            rows, tokens, asked, found, before = [], [], [], [], []
            odd = np.zeros((batch.num_rows, ODD_BITS), np.uint8)
            for k in range(batch.num_rows):
                own = lists[k].values.to_numpy(zero_copy_only=False)
                f = founds[k].as_py()
                a = 0 if near[k].as_py() else asks[k].as_py()
                odd[k] = np.bincount((own >> 32) & (ODD_BITS - 1), minlength=ODD_BITS) & 1
                weight = counts[own & (COUNTER_CELLS - 1)]
                order = np.lexsort((own, weight))[: max(a, f)]
                place = np.flatnonzero(weight[order])
                rows.append(np.full(len(place), k))
                prefix = own[order[place]]
                tokens.append(prefix)
                before += [prefix[:i] for i in range(len(prefix))] if len(prefix) <= MOST_BEFORE else [None] * len(prefix)
                asked.append(place < a)
                found.append(place < f)
            at = pa.array(np.concatenate(rows) if rows else np.zeros(0, _I))
            odd = np.packbits(odd, axis=1).view(_I)
            yield pa.RecordBatch.from_arrays(
                [c.take(at) for c in (keys, hubs, sizes, changed, *(pa.array(odd[:, k]) for k in range(len(ODD))))]
                + [pa.array(np.concatenate(x) if x else np.zeros(0, t), y) for x, t, y in ((tokens, _I, pa.int64()), (asked, bool, pa.bool_()), (found, bool, pa.bool_()))]
                + [pa.array(before, pa.list_(pa.int64()))],
                ["key", "hub", "n", "d", *ODD, "token", "asked", "found", "before"],
            )

    odds = ", ".join(f"{c} long" for c in ODD)
    return changes.mapInArrow(run, f"key long, hub long, n int, d int, {odds}, token long, asked boolean, found boolean, before array<long>")


def _allowed(total, percent: int):
    return F.floor(total * (100 - percent) / (100 + percent))


def _change_pairs(changes: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs of one hub in different components that may be linked; one of the two is not linked to the hub.

    Sets of d and e changes that may differ in H shingles share (d + e - H) / 2 of their
    changes or more. As one set has more changes than any that is linked to the hub, the
    other shares more than half of its own; and since e is d - H or more, d - H are shared. A
    prefix of either, in one order for all, so holds a shared one.
    """
    label = known.select("node", F.col("component").alias("c"))
    rows = _rarest_first(changes).join(label, F.col("key") == F.col("node"), "left").withColumn("c", F.coalesce("c", "key"))

    def side(kept: str, tag: str) -> DataFrame:
        return rows.filter(kept).select(*[F.col(x).alias(f"{x}_{tag}") for x in ("hub", "key", "n", "d", "c", "token", "before", *ODD)])

    far, held = side("asked", "r"), side("found", "s")
    gap = _allowed(F.col("n_r") + F.col("n_s"), percent)
    apart = sum(F.bit_count(F.col(f"{c}_r").bitwiseXOR(F.col(f"{c}_s"))) for c in ODD)
    met = far.join(held, (F.col("hub_r") == F.col("hub_s")) & (F.col("token_r") == F.col("token_s"))).filter(
        (F.col("c_r") != F.col("c_s")) & (F.abs(F.col("d_r") - F.col("d_s")) <= gap) & (apart <= gap)
        & ~F.coalesce(F.arrays_overlap("before_r", "before_s"), F.lit(False))
    )
    return met.filter(_fitting(percent, "n_r", "n_s")).select(*_ordered("key_r", "key_s")).distinct()


def component_ids(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    profiles, parts = similar_sets(docs, layout)
    classes = profiles.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = classes.join(parts, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("component", "key").alias("c"))
    names = named.groupBy("c").agg(F.min("least").alias("component_id"))
    of_class = named.join(names, "c").select(F.col("key").alias("k"), "component_id")
    full = profiles.filter("n > 0").join(of_class, F.col("key") == F.col("k")).select("doc_id", "n", "component_id")
    empty = profiles.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.union(empty).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """The documents that name their component; all other columns as they are.

    A document with a null doc_id stays. Repeated rows of a representative all stay.
    """
    ids = component_ids(docs, layout).filter("doc_id = component_id").select(F.col("doc_id").alias("__d")).distinct()
    kept = docs.join(ids, docs["doc_id"] == F.col("__d"), "left_semi")
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))
