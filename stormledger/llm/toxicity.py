"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are tagged toxic or not. The field scores a token by its hashed features (the
word, its first and last letters, its kind and length, the words beside it) and each
pair of neighbours by their tags. Forward-backward gives every token's marginal; toxic
spans are runs of tokens with a marginal of one half or more, with their offsets. A
document is scored from its largest marginal and from the probability that the chain
holds any toxic token, set against the labels by a logistic curve; tokens with a marginal
below ``QUIET`` do not count, so that no text is toxic by its length.

Labels name documents, so labelled tokens are derived first: in a toxic document those
words are toxic whose share among toxic documents most exceeds that among others, as
far as they come near the best of their document. The field learns from windows
around such tokens and from windows of documents labelled not toxic.

What is learned comes from a bounded sample: at most ``MOST_LABELS`` labelled documents (all,
or those of the smallest id hash), of these at most ``MOST_SEEDS`` words and
``MOST_WINDOWS`` windows of each kind. Every whole text is scored. The chain is advanced in
chunks that are joined by their transfer matrices, so long texts cost no more than short ones.

Null or empty text, or text without a token: no spans, the score of a document without any
sign. A null label or doc_id teaches nothing; if several labels name a document, any toxic one
counts. Without toxic or other labels, or without a word that tells them apart, all
documents get the share of toxic labels (0 without labels). Repeated rows score alike;
an empty table gives an empty one; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stormledger.llm.shingles import mix, slices, word_hashes
from stormledger.runtime import cut_at, scratch

CELL_BITS = 18
FEATURES = 6
MOST_LABELS = 200_000
MOST_SEEDS = 2000
MOST_WINDOWS = 4000
LEAST_TOXIC = 3  # toxic documents that must hold a word that marks them
LEAST_ODDS = 2.0  # log of the ratio of its shares
NEAR_BEST = 1.0  # log ratio by which a toxic token may fall short of the best of its document
WINDOW = 12  # tokens on either side
WINDOWS_OF_TEXT = 3
STEPS, RATE, DECAY = 60, 0.25, 1e-3
QUIET = 0.02
CHUNK = 64  # tokens of a chain that are advanced one by one
_U = np.uint64
_I = np.int64
_SALT = mix(np.arange(1, FEATURES + 1).astype(_U))

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_KIND = np.zeros(256, np.uint8)
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 1, 2, 4, 8


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each token, a run of letters and digits, and for each text its first token (n + 1 entries)."""
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    inside = _TOKEN[data]
    before = np.concatenate(([False], inside[:-1])) & ~fresh[:-1]
    after = np.concatenate((inside[1:], [False])) & ~fresh[1:]
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


def feature_cells(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Cells of each token's features (tokens x FEATURES)."""
    words = word_hashes(data, starts, ends)
    head = word_hashes(data, starts, np.minimum(starts + 3, ends))
    tail = word_hashes(data, np.maximum(ends - 3, starts), ends)
    kinds = np.bitwise_or.reduceat(_KIND[data], starts) if len(starts) else np.zeros(0, np.uint8)
    shape = kinds.astype(_U) << _U(8) | np.minimum(ends - starts, 15).astype(_U)
    edge = np.zeros(len(starts) + 1, bool)  # a text begins here
    edge[first] = True
    left = np.where(edge[:-1], _U(1), np.concatenate((np.zeros(1, _U), words[:-1])) if len(words) else words)
    right = np.where(edge[1:], _U(1), np.concatenate((words[1:], np.zeros(1, _U))) if len(words) else words)
    every = (words, head, tail, shape, left, right)
    return np.stack([(mix(x ^ _SALT[k]) >> _U(64 - CELL_BITS)).astype(_I) for k, x in enumerate(every)], axis=1)


class Field(NamedTuple):
    """Weights of the cells, of every toxic token, and of the tags' neighbourhood (log; 0 for two untoxic ones)."""

    cells: np.ndarray
    bias: float
    start: float
    to_toxic: float
    from_toxic: float
    stay_toxic: float

    def emissions(self, cells: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(self.cells[cells].sum(axis=1) + self.bias, -30, 30))

    def moves(self) -> np.ndarray:
        return np.exp(np.array([[0.0, self.to_toxic], [self.from_toxic, self.stay_toxic]]))


def scan(odds: np.ndarray, fresh: np.ndarray, moves: np.ndarray, start: float) -> np.ndarray:
    """Odds of toxic that reach each token along the chain, before its own ``odds`` count.

    ``fresh`` tokens begin a chain with odds ``start``. All chunks advance together: first
    with both unit vectors, which gives each chunk's transfer matrix; then one pass over
    the chunks finds what enters each; then the chunks are run with that.
    """
    n = len(odds)
    chunks = -(-n // CHUNK)
    own, new = np.ones(chunks * CHUNK), np.zeros(chunks * CHUNK, bool)
    own[:n], new[:n] = odds, fresh
    own, new = own.reshape(chunks, CHUNK).T.copy(), new.reshape(chunks, CHUNK).T.copy()
    (oo, ot), (to, tt) = moves
    o1, t1, o2, t2 = np.ones(chunks), np.zeros(chunks), np.zeros(chunks), np.ones(chunks)
    for k in range(CHUNK):
        o1, t1 = oo * o1 + to * t1, ot * o1 + tt * t1
        o2, t2 = oo * o2 + to * t2, ot * o2 + tt * t2
        if new[k].any():
            o1, t1, o2, t2 = (np.where(new[k], x, y) for x, y in ((1.0, o1), (start, t1), (1.0, o2), (start, t2)))
        t1, t2 = t1 * own[k], t2 * own[k]
        total = o1 + t1 + o2 + t2
        o1, t1, o2, t2 = o1 / total, t1 / total, o2 / total, t2 / total
    enters, ratio = np.zeros(chunks), 0.0
    for k, (a, b, c, d) in enumerate(zip(o1.tolist(), t1.tolist(), o2.tolist(), t2.tolist(), strict=True)):
        enters[k] = ratio
        ratio = (b + ratio * d) / (a + ratio * c)
    out = np.empty((CHUNK, chunks))
    ratio = enters
    for k in range(CHUNK):
        reach = (ot + ratio * tt) / (oo + ratio * to)
        out[k] = np.where(new[k], start, reach)
        ratio = out[k] * own[k]
    return out.T.reshape(-1)[:n]


class Chain(NamedTuple):
    """Forward-backward over consecutive texts."""

    ahead: np.ndarray  # odds up to and with each token
    behind: np.ndarray  # odds of what follows it
    marginal: np.ndarray
    any_toxic: np.ndarray  # per token; summed over a text: minus the log probability that it has no toxic token


def forward_backward(field: Field, emissions: np.ndarray, fresh: np.ndarray) -> Chain:
    moves = field.moves()
    last = np.append(fresh[1:], True)
    ahead = scan(emissions, fresh, moves, float(np.exp(field.start))) * emissions
    behind = scan(emissions[::-1], last[::-1], moves.T, 1.0)[::-1]
    odds = ahead * behind
    return Chain(ahead, behind, odds / (1 + odds), np.log1p(ahead * np.where(last, 1.0, moves[1, 0] / moves[0, 0])))


def train(windows: list[tuple[str, list[int]]], steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Field:
    """A field fitted to windows of (words joined by spaces, tags) by gradient steps with moment estimates."""
    texts = pa.array([t for t, _ in windows], pa.string())
    parts = []
    for _, _, data, offsets in slices(texts, 1 << 30):
        starts, ends, first = tokens_of(data, offsets)
        parts.append((feature_cells(data, starts, ends, first), first))
    cells, first = parts[0]
    tags = np.concatenate([np.asarray(t, float) for _, t in windows])
    fresh = np.zeros(len(tags), bool)
    fresh[first[:-1]] = True
    inner = np.flatnonzero(~fresh)
    flat, n = cells.ravel(), len(windows)
    pairs = np.bincount((tags[inner - 1] * 2 + tags[inner]).astype(int), minlength=4).astype(float)
    seen = np.array([tags.sum(), tags[fresh].sum(), *pairs[1:]])
    size = 1 << CELL_BITS
    value, mean, square = np.zeros(size + 5), np.zeros(size + 5), np.zeros(size + 5)
    for step in range(1, steps + 1):
        field = Field(value[:size], *value[size:].tolist())
        e = field.emissions(cells)
        chain = forward_backward(field, e, fresh)
        moves = field.moves()
        before, after = chain.ahead[inner - 1], e[inner] * chain.behind[inner]
        joint = np.stack([np.full(len(inner), moves[0, 0]), moves[0, 1] * after, moves[1, 0] * before, moves[1, 1] * before * after])
        joint /= joint.sum(axis=0)
        slope = np.empty(size + 5)
        slope[:size] = np.bincount(flat, weights=np.repeat(chain.marginal - tags, FEATURES), minlength=size)
        slope[size:] = np.array([chain.marginal.sum(), chain.marginal[fresh].sum(), *joint.sum(axis=1)[1:]]) - seen
        slope = slope / n + decay * value
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        value = value - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return Field(value[:size].astype(np.float32), *value[size:].tolist())


def signs(field: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For consecutive texts: their signs (text x 2), each token's start, end, marginal, and first token of each text."""
    starts, ends, first = tokens_of(data, offsets)
    counts = np.diff(first)
    found = np.full((len(counts), 2), -12.0)
    if not len(starts):
        return found, starts, ends, np.zeros(0), first
    held = np.flatnonzero(counts)
    fresh = np.zeros(len(starts), bool)
    fresh[first[held]] = True
    chain = forward_backward(field, field.emissions(feature_cells(data, starts, ends, first)), fresh)
    most = np.maximum.reduceat(chain.marginal, first[held])
    found[held, 0] = np.clip(np.log(most + 1e-12) - np.log1p(1e-12 - most), -12, 12)
    loud = np.where(chain.marginal >= QUIET, chain.any_toxic, 0)
    found[held, 1] = np.clip(np.log(np.add.reduceat(loud, first[held]) + 1e-12), -12, 12)
    return found, starts, ends, chain.marginal, first


def fit_curve(found: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic weights of the signs and a constant, by Newton's method."""
    x = np.column_stack([found, np.ones(len(found))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


class Model(NamedTuple):
    field: Field | None
    curve: np.ndarray | None
    share: float  # of toxic labels, the score where nothing could be learned

    def scores(self, found: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(found), self.share)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([found, np.ones(len(found))]) @ self.curve, -30, 30)))


def _label_sample(labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    known = labels.select(F.col("doc_id").cast("long").alias("d"), F.col("toxic").cast("int").alias("t")).dropna()
    known = known.groupBy("d").agg(F.max("t").alias("t")).orderBy(F.xxhash64("d"), "d").limit(most).toPandas().sort_values("d")
    return known["d"].to_numpy(_I), (known["t"].to_numpy(_I) > 0).astype(_I)


def _labelled(docs: DataFrame, sample: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, text, toxic) of the documents of the sample."""
    held = docs.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic = held.value
        for batch in batches:
            asked = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(ids, asked), len(ids) - 1)
            ok = np.flatnonzero(ids[at] == asked)
            some = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some), pa.array(toxic[at[ok]])], ["doc_id", "text", "toxic"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).dropna(subset=["doc_id"])
    return slim.mapInArrow(run, "doc_id long, text string, toxic long")


def _seeds(known: DataFrame, toxic: int, others: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that mark toxic documents, sorted, and their log odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            for a, z, data, offsets in slices(batch.column(0)):
                starts, ends, first = tokens_of(data, offsets)
                owner = np.repeat(np.arange(z - a), np.diff(first))
                order = np.lexsort((words := word_hashes(data, starts, ends), owner))
                words, owner = words[order], owner[order]
                once = np.ones(len(words), bool)
                once[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
                words, tag = words[once], tags[a:z][owner[once]]
                distinct, back = np.unique(words, return_inverse=True)
                both = [np.bincount(back, weights=w, minlength=len(distinct)).astype(_I) for w in (tag, 1 - tag)]
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(_I)), *map(pa.array, both)], ["word", "t", "o"])

    counted = known.select("text", "toxic").mapInArrow(run, "word long, t long, o long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("o") + 0.5) / (others + 1))
    rows = counted.filter(F.col("t") >= least).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    rows = rows.orderBy(F.desc("odds"), "word").limit(most).toPandas()
    words = rows["word"].to_numpy(_I).view(_U)
    order = np.argsort(words)
    return words[order], rows["odds"].to_numpy(float)[order]


def _windows(known: DataFrame, seeds: tuple[np.ndarray, np.ndarray], most: int) -> list[tuple[str, list[int]]]:
    """At most ``most`` windows of toxic and of other documents, those of the smallest hash."""
    held = known.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, odds = held.value
        for batch in batches:
            ids, toxic = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            rows = []
            for a, z, data, offsets in slices(batch.column(1)):
                starts, ends, first = tokens_of(data, offsets)
                words = word_hashes(data, starts, ends)
                at = np.minimum(np.searchsorted(marks, words), len(marks) - 1)
                odd = np.where(marks[at] == words, odds[at], -np.inf)
                raw = data.tobytes()
                for k in range(z - a):
                    low, high = int(first[k]), int(first[k + 1])
                    if low == high:
                        continue
                    tags = np.zeros(high - low, _I)
                    if toxic[a + k]:
                        best = odd[low:high].max()
                        if best == -np.inf:
                            continue
                        tags[odd[low:high] >= best - NEAR_BEST] = 1
                    turn = mix(np.arange(high - low).astype(_U) + mix(np.array([ids[a + k]], _I).view(_U)))
                    spots = np.flatnonzero(tags) if toxic[a + k] else np.arange(high - low)
                    for spot in spots[np.argsort(turn[spots])[:WINDOWS_OF_TEXT]].tolist():
                        one, two = max(0, spot - WINDOW), min(high - low, spot + WINDOW + 1)
                        text = b" ".join(raw[s:e] for s, e in zip(starts[low + one : low + two].tolist(), ends[low + one : low + two].tolist(), strict=True))
                        rows.append((int(turn[spot].view(_I)), int(toxic[a + k]), text.decode("utf-8", "replace"), tags[one:two].tolist()))
            yield pa.RecordBatch.from_pylist([dict(zip(("turn", "toxic", "words", "tags"), r, strict=True)) for r in rows], schema=schema)

    schema = pa.schema([("turn", pa.int64()), ("toxic", pa.int64()), ("words", pa.string()), ("tags", pa.list_(pa.int64()))])
    found = known.mapInArrow(run, "turn long, toxic long, words string, tags array<long>")
    rows = [r for kind in (0, 1) for r in found.filter(F.col("toxic") == kind).orderBy("turn", "words").limit(most).collect()]
    return [(r["words"], r["tags"]) for r in rows]


def learn(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS, least_toxic: int = LEAST_TOXIC) -> Model:
    """A model of the documents that ``labels`` (doc_id, toxic) names."""
    sample = _label_sample(labels, most_labels)
    share = float(sample[1].mean()) if len(sample[1]) else 0.0
    if share in (0.0, 1.0):
        return Model(None, None, share)
    with scratch():
        known, _ = cut_at(_labelled(docs, sample), "toxic-labelled")
        n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        seeds = _seeds(known, toxic, n - toxic, least_toxic, MOST_SEEDS)
        if not len(seeds[0]) or toxic == n:
            return Model(None, None, toxic / n if n else share)
        known = known.repartition(known.sparkSession.sparkContext.defaultParallelism)
        field = train(_windows(known, seeds, MOST_WINDOWS))
        rows = _signs(known, field).toPandas()
    curve = fit_curve(np.stack([rows[c].to_numpy(float) for c in ("s0", "s1")], axis=1), rows["toxic"].to_numpy(float))
    return Model(field, curve, toxic / n)


def _signs(known: DataFrame, field: Field) -> DataFrame:
    held = known.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, data, offsets in slices(batch.column(0)):
                found = signs(held.value, data, offsets)[0]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, z - a), *(pa.array(found[:, k]) for k in range(2))], ["toxic", "s0", "s1"])

    return known.select("text", "toxic").mapInArrow(run, "toxic long, s0 double, s1 double")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, score (0 to 1) and spans of each whole text.

    Spans are (start, end, marginal): code point offsets of a run of toxic tokens, and its
    largest marginal.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])

    def spans(data, offsets, starts, ends, marginal, first) -> pa.Array:
        toxic = marginal >= 0.5
        fresh = np.zeros(len(toxic) + 1, bool)
        fresh[first] = True
        joined = toxic & np.concatenate(([False], toxic[:-1])) & ~fresh[:-1] if len(toxic) else toxic
        begin = np.flatnonzero(toxic & ~joined)
        goes_on = np.append(joined[1:], False) if len(toxic) else joined
        end = np.flatnonzero(toxic & ~goes_on)
        if not len(begin):
            return pa.ListArray.from_arrays(np.zeros(len(offsets), np.int32), pa.array([], kind))
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        owner = np.searchsorted(first, begin, "right") - 1
        zero = points[offsets[owner]]
        best = np.maximum.reduceat(np.where(toxic, marginal, 0), begin)
        rows = pa.StructArray.from_arrays(
            [pa.array((points[starts[begin]] - zero).astype(np.int32)), pa.array((points[ends[end]] - zero).astype(np.int32)), pa.array(best)], fields=list(kind)
        )
        return pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(len(offsets))).astype(np.int32), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for a, z, data, offsets in slices(batch.column(1)):
                keys = batch.column(0).slice(a, z - a)
                if model.field is None:
                    found, lists = np.zeros((z - a, 2)), pa.ListArray.from_arrays(np.zeros(z - a + 1, np.int32), pa.array([], kind))
                else:
                    found, *rest = signs(model.field, data, offsets)
                    lists = spans(data, offsets, *rest)
                yield pa.RecordBatch.from_arrays([keys, pa.array(model.scores(found)), lists], ["key", "score", "spans"])

    of_key = slim.schema["key"].dataType.simpleString()
    out = slim.mapInArrow(run, f"key {of_key}, score double, spans array<struct<start: int, end: int, marginal: double>>")
    return out.select(F.col("key").alias(key), "score", "spans")
