"""Substring tests against a word list, and names of a table found in texts.

A list in the code becomes regular expressions with shared prefixes, of a bounded number
of words each; texts are tested where they are, without a shuffle. A table of names stays
on Spark: filters pick the places of a text that may hold a name, and an equi-join with
the table decides. A filter has ``BITS_A_NAME`` bits for each name up to a fixed size;
a larger table is dealt by hash into shards, each with its own filter and its own pass over
the texts, so what is sent to a task stays bounded and few false places are written at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormledger.runtime import cut_all, cut_at, drop_scratch

# words of one pattern: bounds what a task compiles at once, not what can be matched
PATTERN_WORDS = 10_000


def quote(word: str) -> str:
    """Java-regex form that matches ``word`` literally."""
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in word)


def shortest_words(words: Iterable[str]) -> list[str]:
    """Words that hold no other word of the list: contains-any is unchanged."""
    kept: set[str] = set()
    sizes: list[int] = []
    for word in sorted(set(words), key=lambda w: (len(w), w)):
        if not any(word[i:i + n] in kept for n in sizes for i in range(len(word) - n + 1)):
            kept.add(word)
            if len(word) not in sizes:
                sizes.append(len(word))
    return sorted(kept, key=lambda w: (len(w), w))


def prefix_pattern(words: Iterable[str]) -> str:
    """Alternation that matches exactly these words, with shared beginnings."""
    root: dict = {}
    for word in words:
        node = root
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def render(node: dict) -> str:
        ends = "" in node
        parts = [quote(c) + render(child) for c, child in node.items() if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and not ends else "(?:" + "|".join(parts) + ")"
        return body + "?" if ends else body

    return render(root)


def contains_any(col: Column, words: Iterable[str]) -> Column:
    """True when ``col`` holds any of ``words`` as a substring; null is false.

    The empty word is held by every text. Words go into patterns of at most
    ``PATTERN_WORDS`` words each, whatever the length of the list; a text is
    scanned once per pattern.
    """
    words = [w for w in words if w is not None]
    if "" in words:
        return col.isNotNull()
    short = shortest_words(words)
    if not short:
        return F.lit(False)
    if len(short) == 1:
        return F.coalesce(F.contains(col, F.lit(short[0])), F.lit(False))
    short.sort()  # neighbours share beginnings
    patterns = [prefix_pattern(short[i:i + PATTERN_WORDS]) for i in range(0, len(short), PATTERN_WORDS)]
    return F.coalesce(reduce(or_, [col.rlike(p) for p in patterns]), F.lit(False))


# ---------------------------------------------------------------------------
# name tables of any size
# ---------------------------------------------------------------------------

BITS_A_NAME = 64
# bits of one filter: what a task is sent at once, whatever the number of names
MOST_BITS_LOG2 = 27
LEAST_BITS_LOG2 = 12
# cells of a name: one for each beginning under which names are looked for, the others of the whole
WHOLE_CELLS = 3
CHUNK = 1 << 20  # units hashed at once

_BASE = 0x9E3779B97F4A7C15
_LEAD, _WHOLE = 0, 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _band(n: int) -> int:
    """Units of the beginning under which a name of ``n`` units is looked for first."""
    return 1 << (n.bit_length() - 1)


class _Runs:
    """Hashes of runs of units (words or characters) of several rows."""

    def __init__(self, units: np.ndarray):
        size = len(units)
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE, np.uint64)]))
        self.inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(units) * powers[:-1], dtype=np.uint64)])

    def hashes(self, at: np.ndarray, n, kind: int) -> np.ndarray:
        """``n``: units of each run, one number or one per run."""
        run = (self.sums[at + n] - self.sums[at]) * self.inverse[at]
        return _mixed(run ^ self.seed(n, kind))

    def beginnings(self, n: int) -> np.ndarray:
        """The hashes of ``hashes`` for the runs of ``n`` units at all places that have as many behind them."""
        size = max(0, len(self.sums) - n)
        run = self.sums[n:] - self.sums[:size]
        run *= self.inverse[:size]
        return _mixed(run ^ self.seed(n, _LEAD))

    @staticmethod
    def seed(n, kind: int) -> np.ndarray:
        return _mixed(np.atleast_1d(np.asarray(n, np.uint64)) * np.uint64(2) + np.uint64(kind + 1))


class Shard(NamedTuple):
    """What a task knows of one shard of a table of names."""

    number: int
    shards: int
    log2: int  # of the bits
    words: np.ndarray  # the bits, 64 in each
    sizes: dict[int, list[int]]  # sizes of names, by the beginning under which they are looked for

    def holds(self, cells: np.ndarray) -> np.ndarray:
        return (self.words[cells >> 6] >> (cells & 63)) & 1 == 1


def _shard_of(whole: np.ndarray, shards: int) -> np.ndarray:
    return (whole % np.uint64(shards)).astype(np.int64)


def _cell(hashes: np.ndarray, log2: int, k: int = 0) -> np.ndarray:
    return (_mixed(hashes + np.uint64(k)) >> np.uint64(64 - log2)).astype(np.int64)


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``CHUNK`` units each."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        yield first, last
        first = last


def _found(units: np.ndarray, offsets: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs inside a row that the shard's filter lets through, by start."""
    runs = _Runs(units)
    every = np.arange(len(units))
    left = np.repeat(offsets[1:], np.diff(offsets)) - every
    starts, ns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = None
    for band, of_band in sorted(shard.sizes.items()):
        # a name has the beginnings of all smaller bands too, so each band is asked for where the one before was found
        if at is None:
            lead = shard.holds(_cell(runs.beginnings(band), shard.log2))
            at = np.flatnonzero(lead & (left[:len(lead)] >= band))
        else:
            at = at[left[at] >= band]
            at = at[shard.holds(_cell(runs.hashes(at, band, _LEAD), shard.log2))]
        for n in of_band:
            here = at[left[at] >= n]
            whole = runs.hashes(here, n, _WHOLE)
            for k in range(WHOLE_CELLS + 1):
                ok = _shard_of(whole, shard.shards) == shard.number if not k else shard.holds(_cell(whole, shard.log2, k))
                here, whole = here[ok], whole[ok]
            starts.append(here)
            ns.append(np.full(len(here), n))
    start, n = np.concatenate(starts), np.concatenate(ns)
    order = np.lexsort((n, start))
    return start[order], n[order]


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after the other, and where each text begins."""
    offsets = np.concatenate([[0], np.cumsum([len(t or "") for t in texts])]).astype(np.int64)
    return np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), offsets


def _listed(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offsets[0]:offsets[-1]].astype(np.int64).view(np.uint64), offsets - offsets[0]


def _marks(names: DataFrame, units: Column, words: bool, shards: int, log2: int, bands: list[int]) -> DataFrame:
    """(shard, place, bits): the filters' 64-bit words that are not 0."""
    apart = _listed if words else lambda column: _points(column.to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = apart(batch.column(0))
            n = np.diff(offsets)
            runs, at = _Runs(values), offsets[:-1]
            whole = runs.hashes(at, n, _WHOLE)
            of_name = _shard_of(whole, shards)
            cells, shard = [_cell(whole, log2, k) for k in range(1, WHOLE_CELLS + 1)], [of_name] * WHOLE_CELLS
            for band in bands:
                cells.append(_cell(runs.hashes(at[n >= band], band, _LEAD), log2))
                shard.append(of_name[n >= band])
            cells, shard = np.concatenate(cells), np.concatenate(shard)
            place = (shard << (log2 - 6)) + (cells >> 6)
            order = np.argsort(place, kind="stable")
            first = np.flatnonzero(np.diff(place[order], prepend=-1))
            bits = np.left_shift(np.uint64(1), (cells & 63).astype(np.uint64))[order]
            bits = np.bitwise_or.reduceat(bits, first) if len(first) else bits
            place = place[order[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place >> (log2 - 6)), pa.array(place & ((1 << (log2 - 6)) - 1)), pa.array(bits.view(np.int64))], ["shard", "place", "bits"]
            )

    marked = names.select(units.alias("units")).mapInArrow(run, "shard long, place long, bits long")
    return marked.groupBy("shard", "place").agg(F.bit_or("bits").alias("bits"))


def _shards(names: DataFrame, units: Column, words: bool) -> Iterator[Shard]:
    """The shards of a table of names, one at a time; the driver gets bits and sizes, never a name."""
    size = F.size(units) if words else F.char_length(units)
    n, found = names.agg(F.count(units), F.sort_array(F.collect_set(size))).first()
    sizes: dict[int, list[int]] = {}
    for k in found:
        sizes.setdefault(_band(k), []).append(k)
    shards = max(1, -(-n * BITS_A_NAME >> MOST_BITS_LOG2))
    log2 = min(MOST_BITS_LOG2, max(LEAST_BITS_LOG2, (n * BITS_A_NAME // shards).bit_length()))
    marks, path = _marks(names, units, words, shards, log2, sorted(sizes)), None
    if shards > 1:  # the bits of all shards are made in one pass
        marks, path = cut_at(marks, "name-bits")
    for number in range(shards):
        rows = marks.filter(F.col("shard") == number).select("place", "bits").toArrow()
        held = np.zeros(1 << (log2 - 6), np.int64)
        held[rows["place"].to_numpy()] = rows["bits"].to_numpy()
        yield Shard(number, shards, log2, held, sizes)
    if path:
        drop_scratch(names.sparkSession, path)


def _word_runs(held) -> Callable[[pa.Array], pa.Array]:
    def found(column: pa.Array) -> pa.Array:
        units, offsets = _listed(column)
        out, counts = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        for first, last in _chunks(offsets):
            here = offsets[first:last + 1] - offsets[first]
            start, n = _found(units[offsets[first]:offsets[last]], here, held.value)
            row = np.searchsorted(here, start, "right") - 1
            out.append((start - here[row] << 32) + n)
            counts.append(np.bincount(row, minlength=last - first))
        ends = np.cumsum(np.concatenate(counts)).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(out)))

    return found


def _text_parts(held) -> Callable[[pa.Array], pa.Array]:
    def found(column: pa.Array) -> pa.Array:
        texts, out = column.to_pylist(), []
        edges = np.concatenate([[0], np.cumsum([len(t or "") for t in texts])])
        for first, last in _chunks(edges):
            units, here = _points(texts[first:last])
            start, n = _found(units, here, held.value)
            row = np.searchsorted(here, start, "right") - 1
            of_row: list[set[str]] = [set() for _ in range(last - first)]
            for r, i, k in zip(row.tolist(), (start - here[row]).tolist(), n.tolist(), strict=True):
                of_row[r].add(texts[first + r][i:i + k])
            out += [sorted(s) for s in of_row]
        return pa.array(out, pa.list_(pa.string()))

    return found


def scan_names(
    names: DataFrame, name_units: Column, words: bool, places: Callable[[Callable[[Column], Column]], DataFrame], label: str
) -> DataFrame:
    """What the filters of a table of names let through, written once, one pass for each shard.

    Names are runs of units: hashes of words (``array<bigint>``) or characters (``string``). No name is
    missed. ``places`` gets a Column function that names the runs of a row and returns the rows
    to write; the function gives, for an array of word hashes, ``array<bigint>`` of
    ``start * 2**32 + size`` (starts from 0), and for a text its distinct substrings.
    """
    def frames() -> Iterator[DataFrame]:
        for shard in _shards(names, name_units, words):
            held = names.sparkSession.sparkContext.broadcast(shard)
            found = F.arrow_udf("array<bigint>")(_word_runs(held)) if words else F.arrow_udf("array<string>")(_text_parts(held))
            yield places(found)
            held.unpersist()

    return cut_all(frames(), label)


def join_names(found: DataFrame, names: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows of the stored table ``found`` joined with the rows of ``names`` of the same ``key``.

    A key that holds more than one partition's share of the rows is spread over all
    partitions; there are fewer such keys than partitions.
    """
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = found.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = [r[0] for r in counted.filter(F.col("n") * parts > found.count()).select(key).collect()]
    spread = F.when(F.col(key).isin(hot), F.lit(parts)).otherwise(F.lit(1))
    salted = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), spread - 1)))
    return (
        found.withColumn("_salt", F.pmod(F.xxhash64(*found.columns), spread).cast("int"))
        .join(salted, [key, "_salt"], how)
        .drop("_salt")
    )


def keep_names(found: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Rows of the stored table ``found`` whose ``key`` is in the distinct ``names``; see ``join_names``."""
    return join_names(found, names.select(key), key, "left_semi")


def filter_contains_any(df: DataFrame, text_col: str, words: DataFrame, keep: Column | None = None) -> DataFrame:
    """Rows of ``df`` whose lower-cased text holds any word of the ``words`` table, or for which ``keep`` is true.

    The table may have any size: substrings that its filters let through are joined with it, under
    a 128-bit hash of their text. Only these narrow rows are written; ``df`` is read again
    and keeps the rows whose text's hash was found.
    """
    text = F.lower(text_col)
    keep = F.lit(False) if keep is None else F.coalesce(keep, F.lit(False))
    listed = words.toDF("_part").dropna().distinct()
    if not listed.filter("_part = ''").isEmpty():  # the empty word is held by every text
        return df.filter(keep | text.isNotNull())
    mark = [F.xxhash64(text), F.xxhash64(text, F.lit(1))]
    slim = df.filter(~keep & text.isNotNull()).select(*[m.alias(f"_m{k}") for k, m in enumerate(mark)], text.alias("_text"))
    found = scan_names(
        listed, F.col("_part"), False,
        lambda parts: slim.select("_m0", "_m1", F.explode(parts(F.col("_text"))).alias("_part")), "held",
    )
    held = keep_names(found, listed, "_part").select("_m0", "_m1").distinct()
    met = df.join(held, (mark[0] == F.col("_m0")) & (mark[1] == F.col("_m1")), "left")
    return met.filter(keep | F.col("_m0").isNotNull()).select(*[df[c] for c in df.columns])
