"""Collocated phrases, counted in mergeable counting quotient filters.

Words are numbered, n-grams of word numbers are packed and permuted invertibly, and
every task counts its n-grams in a counting quotient filter (``quotient_filter``). Filters
are cut into shards by the leading bits of the permuted value, which spreads even the
commonest n-grams evenly; each shard's sorted filters are merged and the counts are exact.

1. Texts become blocks of local word numbers with breaks between pieces, beside the
   block's own word list, written once. Words that are frequent in a language get a
   number; all others break phrases, as no phrase is more frequent than its words. Numbers
   go back to the blocks through the block's word list, so no word table is broadcast.
2. Pairs, triples and quadruples are counted in turn. Of longer ones only those are
   counted whose two shorter parts pass a bit map of the frequent ones. The map has a
   fixed size; if it lets others through, these are counted and dropped by their count.
3. Frequent phrases are joined with the counts of both parts of every cut. The score is
   computed in decimals, exactly.

Text is lower-cased in A-Z only, cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into
words ``[^\\x20\\x09]+``. Words of one block are told apart by 64-bit hashes (two different ones
of a block meet with a probability below 1e-8); everything else is exact.

Null or empty text: no words. Null language: ``und``, one with documents that say so. Each row is
a document; repeated rows count each. Ties: see ``top_phrases``. An empty table gives an
empty one; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from stormledger.llm import quotient_filter as Q
from stormledger.llm.shingles import SLICE_BYTES, mix, slices, word_hashes
from stormledger.runtime import cut_at, drop_scratch, scratch
from stormledger.sources.snapshots import with_row_index

LONGEST = 4
LEAST_TIMES = 30
COVERED = 80  # percent of a phrase's occurrences inside one longer phrase that drop it
TOP = 2000
SCALE = 2_000_000
BLOCK_BYTES = 1 << 23
FILTER_ENTRIES = 1 << 20  # of a task's filter before it is handed on
SHARD_WORDS = 1 << 18  # word occurrences for each shard of the filters
MAP_BITS = 1 << 26
_U = np.uint64
_I = np.int64

_GAP = np.zeros(256, bool)
_GAP[[9, 32]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word, and whether it is the first of its piece."""
    fresh = np.zeros(len(data) + 1, bool)  # a text begins here
    fresh[offsets] = True
    inside = ~(_GAP | _BREAK)[data]
    before = np.concatenate(([False], inside[:-1])) & ~fresh[:-1]
    after = np.concatenate((inside[1:], [False])) & ~fresh[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    breaks = np.cumsum(_BREAK[data] | fresh[:-1])
    first = np.diff(breaks[starts], prepend=-1) != 0
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, first


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word hashes, worked on in stretches of bounded size."""
    out, first = [np.zeros(0, _U)], 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + SLICE_BYTES)))
        low, high = starts[first], ends[last - 1]
        out.append(word_hashes(data[low:high], starts[first:last] - low, ends[first:last] - low))
        first = last
    return np.concatenate(out)


def blocks_of(docs: DataFrame, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, tokens, langs, words, times): packed local word numbers (0: a break) and what they stand for."""
    slim = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            for a, z, data, offsets in slices(batch.column(0), block_bytes):
                starts, ends, owner, first = _words(data, offsets)
                if not len(starts):
                    continue
                code = codes[a:z][owner]
                asked = mix(_hashes(data, starts, ends) + mix(code.astype(_U)))
                _, at, back, times = np.unique(asked, return_index=True, return_inverse=True, return_counts=True)
                order = np.argsort(-times, kind="stable")  # common words get short numbers
                local = np.empty(len(order), _I)
                local[order] = np.arange(1, len(order) + 1)
                tokens = np.zeros(len(starts) + int(first.sum()), _I)
                tokens[np.arange(len(starts)) + np.cumsum(first)] = local[back]
                raw = data.tobytes().translate(_FOLD)
                at = at[order]
                spelled = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]), pa.array([Q.pack_numbers(tokens)], pa.binary()),
                        pa.array([[names[c] for c in code[at].tolist()]], pa.list_(pa.string())),
                        pa.array([spelled], pa.list_(pa.string())), pa.array([times[order]], pa.list_(pa.int64())),
                    ],
                    ["block", "tokens", "langs", "words", "times"],
                )
                number += 1

    return slim.mapInArrow(run, "block long, tokens binary, langs array<string>, words array<string>, times array<long>")


def _numbered(blocks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(ids): the blocks' tokens as packed numbers of ``vocabulary``; 0 for breaks and words without a number."""
    listed = blocks.select("block", F.posexplode(F.arrays_zip("langs", "words")).alias("at", "own"))
    known = listed.select("block", "at", F.col("own.langs").alias("lang"), F.col("own.words").alias("word")).join(vocabulary, ["lang", "word"])
    lists = known.groupBy(F.col("block").alias("b")).agg(F.collect_list(F.struct("at", "id")).alias("known"))
    met = blocks.select("block", "tokens").join(lists, F.col("block") == F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tokens = Q.unpack_numbers(batch.column(0)[k].as_py()).astype(_I)
                ids = np.zeros(int(tokens.max()) + 1, _I)
                ids[batch.column(1)[k].values.to_numpy(zero_copy_only=False) + 1] = batch.column(2)[k].values.to_numpy(zero_copy_only=False)
                found = ids[tokens]
                found = found[(found != 0) | (np.concatenate(([0], found[:-1])) != 0)]
                yield pa.RecordBatch.from_arrays([pa.array([Q.pack_numbers(found)], pa.binary())], ["ids"])

    return met.select("tokens", F.col("known.at").alias("at"), F.col("known.id").alias("id")).mapInArrow(run, "ids binary")


def _half(size: int, bits: int) -> int:
    return bits * ((size + 1) // 2)


def _packed(size: int, bits: int, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the permuted n-grams whose word numbers stand in ``columns``."""
    words = [c.astype(_U) for c in columns] + [np.zeros(len(columns[0]), _U)] * (size % 2)
    middle = len(words) // 2
    halves = []
    for part in (words[:middle], words[middle:]):
        value = part[0]
        for w in part[1:]:
            value = value << _U(bits) | w
        halves.append(value)
    return Q.Permutation(_half(size, bits)).forward(*halves)


def _unpacked(size: int, bits: int, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    low = _U((1 << bits) - 1)
    out = []
    for value in Q.Permutation(_half(size, bits)).back(left, right):
        out += [(value >> _U(bits)).astype(_I), (value & low).astype(_I)] if size > 2 else [value.astype(_I)]
    return out[:size]


def _map_places(left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    spread = mix(left * _U(0x9E3779B97F4A7C15) ^ mix(right))
    return [(spread % _U(MAP_BITS)).astype(_I), ((spread >> _U(34)) % _U(MAP_BITS)).astype(_I)]


def _bit_map(grams: DataFrame, size: int, bits: int) -> np.ndarray:
    """Bit map of fixed size that holds every n-gram of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(MAP_BITS // 32, _I)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for at in _map_places(*_packed(size, bits, list(flat.T))):
                np.bitwise_or.at(words, at >> 5, _I(1) << (at & 31))
        place = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(words[place])], ["place", "bits"])

    rows = grams.select("gram").mapInArrow(run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(MAP_BITS // 32, np.uint32)
    words[rows.column("place").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return words


def _passes(words: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    a, b = _map_places(left, right)
    return ((words[a >> 5] >> (a & 31)) & (words[b >> 5] >> (b & 31)) & 1).astype(bool)


def _filters(ids: DataFrame, size: int, bits: int, shard_bits: int, shorter: np.ndarray | None, entries: int) -> DataFrame:
    """(shard, filter): every task's counting quotient filters of the n-grams of ``size`` words."""
    held = None if shorter is None else ids.sparkSession.sparkContext.broadcast(shorter)
    half = _half(size, bits)

    def grams(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x) - size + 1
        whole = np.ones(max(n, 0), bool)
        for k in range(size):
            whole &= x[k : k + n] != 0
        at = np.flatnonzero(whole)
        if held is not None and len(at):
            for shift in (0, 1):
                part = [x[at + shift + k] for k in range(size - 1)]
                at = at[_passes(held.value, *_packed(size - 1, bits, part))]
        return _packed(size, bits, [x[at + k] for k in range(size)])

    def shards(one: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        left, right, counts = one
        shard = (left >> _U(half - shard_bits)).astype(_I)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        ends = [*cuts[1:].tolist(), len(shard)]
        made = [Q.encode(half, shard_bits, left[a:z], right[a:z], counts[a:z]) for a, z in zip(cuts.tolist(), ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(shard[cuts]), pa.array(made, pa.binary())], ["shard", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Q.Merger(half)
        for batch in batches:
            for value in batch.column(0):
                counted = Q.summed(half, *grams(Q.unpack_numbers(value.as_py())))
                if len(counted[0]):
                    merger.add(counted)
                if sum(len(f[0]) for f in merger.held) >= entries:
                    yield from shards(merger.result())
                    merger = Q.Merger(half)
        if merger.held:
            yield from shards(merger.result())

    return ids.select("ids").mapInArrow(run, "shard long, filter binary")


def _merged(filters: DataFrame, size: int, bits: int, shard_bits: int, least: int) -> DataFrame:
    """(gram, n) of the n-grams with ``least`` occurrences: the filters of each shard merged, one shard after another."""
    half = _half(size, bits)

    def frequent(merger: Q.Merger) -> pa.RecordBatch:
        left, right, counts = merger.result()
        often = counts >= least
        flat = np.stack(_unpacked(size, bits, left[often], right[often]), axis=1)
        offsets = np.arange(0, flat.size + 1, size, dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat.ravel())), pa.array(counts[often])], ["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, merger = None, Q.Merger(half)
        for batch in batches:
            for shard, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if shard != now and merger.held:
                    yield frequent(merger)
                    merger = Q.Merger(half)
                now = shard
                merger.add(Q.decode(half, shard_bits, shard, value.as_py()))
        if merger.held:
            yield frequent(merger)

    return filters.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "gram array<long>, n long")


def frequent_grams(
    ids: DataFrame, words: int, occurrences: int, longest: int = LONGEST, least: int = LEAST_TIMES,
    shard_words: int = SHARD_WORDS, entries: int = FILTER_ENTRIES,
) -> DataFrame:
    """(gram, n): all n-grams of 2 to ``longest`` of the numbers 1 to ``words`` with ``least`` occurrences."""
    bits = max(1, words.bit_length())
    if bits > 32:
        raise ValueError("n-grams of more than 2**32 words do not fit")
    shard_bits = min(bits, max(0, (occurrences // shard_words).bit_length()))
    found, shorter = None, None
    for size in range(2, longest + 1):
        filters = _filters(ids, size, bits, shard_bits, shorter, entries)
        grams, _ = cut_at(_merged(filters, size, bits, shard_bits, least), f"phrases-{size}")
        found = grams if found is None else found.unionByName(grams)
        if size < longest:
            shorter = _bit_map(grams, size, bits)
    return found


def scored(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, a, l, r, score): each phrase at its lowest-scoring cut, the first of equals.

    ``counts`` (gram, n) must hold the parts of all phrases.
    """
    cuts = grams.select("gram", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    parts = cuts.select(
        "*", F.slice("gram", F.lit(1), F.col("k")).alias("head"), F.slice("gram", F.col("k") + 1, F.size("gram") - F.col("k")).alias("tail")
    )
    heads = counts.select(F.col("gram").alias("head"), F.col("n").alias("l"))
    tails = counts.select(F.col("gram").alias("tail"), F.col("n").alias("r"))
    score = F.expr(f"(CAST(a AS decimal(20,0)) * CAST({SCALE} AS decimal(7,0))) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    low = parts.join(heads, "head").join(tails, "tail").groupBy("gram").agg(F.max("a").alias("a"), best)
    return low.select("gram", "a", "best.l", "best.r", "best.score")


def covered(grams: DataFrame, percent: int = COVERED) -> DataFrame:
    """(gram) of the phrases that lie inside a longer one with ``percent`` of their occurrences or more."""
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("gram") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.size("gram") - m + 1), lambda p: F.slice("gram", p, m)),
    ))
    longer = grams.filter(F.size("gram") > 2).select(F.explode(F.array_distinct(inner)).alias("part"), F.col("n").alias("m"))
    most = longer.groupBy("part").agg(F.max("m").alias("m"))
    exact = (F.col("m").cast("decimal(20,0)") * 100) >= (F.col("n").cast("decimal(20,0)") * percent)
    return grams.join(most, F.col("gram") == F.col("part")).filter(exact).select("gram")


def top_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST_TIMES, percent: int = COVERED, top: int = TOP, **sizes
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by score, then a, then phrase in byte order.

    ``sizes``: block_bytes, shard_words, entries; any of them gives the same result.
    """
    with scratch() as written:
        blocks, blocks_path = cut_at(blocks_of(docs, block_bytes=sizes.pop("block_bytes", BLOCK_BYTES)), "phrase-blocks")
        each = blocks.select(F.explode(F.arrays_zip("langs", "words", "times")).alias("own"))
        each = each.select(F.col("own.langs").alias("lang"), F.col("own.words").alias("word"), F.col("own.times").alias("times"))
        totals, _ = cut_at(each.groupBy("lang").agg(F.sum("times").alias("n")), "phrase-totals")
        often = each.groupBy("lang", "word").agg(F.sum("times").alias("f")).filter(F.col("f") >= least)
        numbered = with_row_index(often, "id").withColumn("id", F.col("id") + 1)
        vocabulary, _ = cut_at(numbered.select("lang", "word", "f", "id"), "phrase-words")
        ids, _ = cut_at(_numbered(blocks, vocabulary.drop("f")), "phrase-ids")
        written.remove(blocks_path)
        drop_scratch(docs.sparkSession, blocks_path)
        words, occurrences = vocabulary.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
        grams = frequent_grams(ids, words, occurrences, longest, least, **sizes)
        single = vocabulary.select(F.array("id").alias("gram"), F.col("f").alias("n"))
        kept = scored(grams, single.unionByName(grams)).join(covered(grams, percent), "gram", "left_anti")
        spelled = (
            kept.select("gram", F.posexplode("gram").alias("at", "id")).join(vocabulary, "id").groupBy("gram")
            .agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        )
        named = kept.join(spelled.select("gram", "lang", F.array_join("words.word", " ").alias("phrase")), "gram")
        order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        out = best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        result, path = cut_at(out, "phrases")
        written.remove(path)
    return result
