"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Two generative models count hashed n-grams: one over the target (documents that
the labels call good), one over the raw corpus (all documents). N-grams are words,
pairs of words, and runs of one to three word shapes (kinds of bytes, length class,
same as the word before). A document's log weight is the mean log ratio of the
two models over its n-grams, times the square root of their number; adding Gumbel noise
and keeping the k largest keys draws k documents without replacement in proportion to
their weights, sharpened by ``temperature``.

k is the number of documents whose weight passes the cut that best tells labelled good
from labelled other ones, unless ``keep`` gives a share of the documents. The k-th key is found exactly by counting keys in
ever finer bins. Counts and weights cover all documents and whole texts; both models
have a fixed size.

Null, empty or wordless text: weight and key null, never kept. Documents without a
label, or with a null one, belong to the raw text only; if several labels name a
document, any good one counts. At most ``MOST_LABELS`` labelled documents are used. Noise depends on doc_id alone: reruns agree, repeated
rows share their fate, and documents with the key of the k-th are all kept. An empty
table gives an empty one; without any good label nothing can be told apart and all
documents with words are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stormledger.llm.shingles import mix, slices, word_hashes, word_spans
from stormledger.runtime import cut_at, drop_scratch

WORD_BITS, SHAPE_BITS = 16, 14
CELLS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
SMOOTHING = 1.0  # counts lent to a target cell of average mass, shared out as the raw model has them
MOST_LABELS = 200_000  # labelled documents the target is learned from: all, or those of the smallest id hash
TEMPERATURE = 0.1
BINS = 4096
_U = np.uint64

_KIND = np.full(256, 32, np.uint8)  # bytes of other scripts
_KIND[:128] = 16  # signs
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 8
_KIND[48:58] = 4
_KIND[65:91] = 2
_KIND[97:123] = 1
_KIND[[9, 10, 11, 12, 13, 32]] = 0


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams of consecutive texts, and the text of each."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    words = word_hashes(data, starts, ends, fold=False)
    kinds = np.bitwise_or.reduceat(_KIND[data], starts)
    length = np.minimum(ends - starts, 31) // 4
    last = _KIND[data[ends - 1]]
    together = text[1:] == text[:-1]
    same = np.concatenate(([False], (words[1:] == words[:-1]) & together))
    shape = mix(kinds.astype(_U) | length.astype(_U) << _U(8) | last.astype(_U) << _U(16) | same.astype(_U) << _U(24))
    pair = mix(words[:-1] * _U(3) + words[1:])[together]
    shape2 = mix(shape[:-1] * _U(5) + shape[1:])
    triple = together[1:] & together[:-1]
    shape3 = mix(shape2[:-1] * _U(7) + shape[2:])[triple]
    word_cells = np.concatenate((words, pair)) >> _U(64 - WORD_BITS)
    shape_cells = (np.concatenate((shape, shape2[together], shape3)) >> _U(64 - SHAPE_BITS)) + _U(1 << WORD_BITS)
    owner = np.concatenate((text, text[1:][together], text, text[1:][together], text[2:][triple]))
    return np.concatenate((word_cells, shape_cells)).astype(np.int64), owner




def _label_sample(labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and goodness of at most ``most`` labelled documents, sorted by id."""
    known = labels.select(F.col("doc_id").cast("long").alias("d"), F.col("quality").cast("int").alias("q")).dropna()
    known = known.groupBy("d").agg(F.max("q").alias("q")).orderBy(F.xxhash64("d"), "d").limit(most).toPandas().sort_values("d")
    return known["d"].to_numpy(np.int64), known["q"].to_numpy(np.int64)


def _labels_of(ids: pa.Array, sample: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1 good, 0 not, -1 unknown."""
    known, quality = sample
    if not len(known):
        return np.full(len(ids), -1)
    asked = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where((known[at] == asked) & ~ids.is_null().to_numpy(zero_copy_only=False), quality[at], -1)


def fit(docs: DataFrame, sample: tuple[np.ndarray, np.ndarray], smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of target and raw model in every cell."""
    held = docs.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        for batch in batches:
            good = _labels_of(batch.column(0), held.value) == 1
            for first, last, data, offsets in slices(batch.column(1)):
                cells, owner = _features(data, offsets)
                raw += np.bincount(cells, minlength=CELLS)
                target += np.bincount(cells[good[first:last][owner]], minlength=CELLS)
        cell = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(raw[cell]), pa.array(target[cell])], ["cell", "raw", "target"])

    sums = docs.select("doc_id", "text").mapInArrow(run, "cell long, raw long, target long").groupBy("cell").agg(F.sum("raw"), F.sum("target")).collect()
    raw, target = np.zeros(CELLS), np.zeros(CELLS)
    for cell, r, t in sums:
        raw[cell], target[cell] = r, t
    if not target.any():
        return np.zeros(CELLS)
    raw = (raw + 0.01) / (raw + 0.01).sum()
    target += smoothing * CELLS * raw
    return np.log(target / target.sum() / raw)


def weighted(docs: DataFrame, ratios: np.ndarray, sample: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The documents with ``__ngrams``, ``__weight`` (null without words) and ``__label`` (1, 0, -1)."""
    held = docs.sparkSession.sparkContext.broadcast((ratios, sample))
    at = {c: k for k, c in enumerate(docs.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, sample = held.value
        for batch in batches:
            weights, counts = [np.zeros(0)], [np.zeros(0, np.int64)]
            for first, last, data, offsets in slices(batch.column(at["text"])):
                cells, owner = _features(data, offsets)
                n = np.bincount(owner, minlength=last - first)
                counts.append(n)
                weights.append(np.bincount(owner, weights=ratios[cells], minlength=last - first) / np.sqrt(np.maximum(n, 1)))
            n = np.concatenate(counts)
            more = [pa.array(n), pa.array(np.concatenate(weights), mask=n == 0), pa.array(_labels_of(batch.column(at["doc_id"]), sample), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "__ngrams", "__weight", "__label"])

    extra = [T.StructField("__ngrams", T.LongType()), T.StructField("__weight", T.DoubleType()), T.StructField("__label", T.IntegerType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def _cut(scores: DataFrame) -> float:
    """The weight that best parts labelled good from other documents: the middle of the widest best gap."""
    low, high = scores.filter("__label >= 0").agg(F.min("__weight"), F.max("__weight")).first()
    if low is None:
        return -np.inf
    width = (high - low) / BINS or 1.0
    place = F.least(F.floor((F.col("__weight") - low) / width), F.lit(BINS - 1)).alias("bin")
    counted = scores.filter("__label >= 0 AND __weight IS NOT NULL").groupBy(place, "__label").agg(F.count("*")).collect()
    held = np.zeros((2, BINS + 1))
    for at, label, n in counted:
        held[min(label, 1), int(at)] = n
    if not held[0].any() or not held[1].any():
        return -np.inf
    wrong = np.concatenate(([0], np.cumsum(held[1]))) + held[0].sum() - np.concatenate(([0], np.cumsum(held[0])))
    best = np.flatnonzero(wrong == wrong.min())
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    widest = max(runs, key=len)
    return float(low + width * (widest[0] + widest[-1]) / 2)


def gumbel_key(weight: Column, temperature: float, seed: int) -> Column:
    """Weight over temperature plus standard Gumbel noise that depends on doc_id and seed."""
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    return weight / temperature - F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest value of the only column, nulls aside; infinity for k = 0, minus infinity past the end."""
    name = F.col(keys.columns[0])
    low, high, n = keys.agg(F.min(name), F.max(name), F.count(name)).first()
    if k <= 0 or k > n:
        return np.inf if k <= 0 else -np.inf
    while low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((name - low) / width), F.lit(BINS - 1)).alias("bin")
        inside = keys.filter((name >= low) & (name <= high))
        bins = sorted(inside.groupBy(place).agg(F.count("*"), F.min(name), F.max(name)).collect(), reverse=True)
        for _, count, least, most in bins:
            if k <= count:
                low, high = least, most
                break
            k -= count
        if count <= BINS:
            return sorted((r[0] for r in inside.filter((name >= low) & (name <= high)).collect()), reverse=True)[k - 1]
    return low


class Resampler:
    """Models, cut and threshold learned from all documents and the labels."""

    def __init__(self, docs: DataFrame, labels: DataFrame, keep: float | None = None, temperature: float = TEMPERATURE, seed: int = 1, most_labels: int = MOST_LABELS):
        self.temperature, self.seed = temperature, seed
        self.sample = _label_sample(labels, most_labels)
        self.ratios = fit(docs, self.sample)
        slim = self._keyed(docs.select("doc_id", "text"))
        self.scores, self.path = cut_at(slim.drop("text"), "importance")
        if keep is None:
            cut = _cut(self.scores)
            k = self.scores.filter(F.col("__weight") >= cut).count()
        else:
            k = round(keep * self.scores.count())
        self.threshold = kth_largest(self.scores.select("__key"), k)

    def _keyed(self, docs: DataFrame) -> DataFrame:
        return weighted(docs, self.ratios, self.sample).withColumn("__key", gumbel_key(F.col("__weight"), self.temperature, self.seed))

    def decisions(self) -> DataFrame:
        """doc_id, n_ngrams, log_weight, gumbel_key, kept of every document."""
        kept = F.coalesce(F.col("__key") >= self.threshold, F.lit(False))
        return self.scores.select(
            "doc_id", F.col("__ngrams").alias("n_ngrams"), F.col("__weight").alias("log_weight"), F.col("__key").alias("gumbel_key"), kept.alias("kept")
        )

    def kept(self, docs: DataFrame) -> DataFrame:
        """The drawn documents with all their columns; texts are weighed again instead of moved."""
        drop_scratch(docs.sparkSession, self.path)
        return self._keyed(docs).filter(F.col("__key") >= self.threshold).select(*docs.columns)
