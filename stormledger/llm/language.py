"""Language spans of mixed texts: script ranges, word scores, Viterbi with a switching penalty.

Learning counts hashed byte n-grams (one to four, with the word's edges, and the whole
word) of lower-cased words per language, and the letters of each script. A word's
script narrows the candidates to the languages that use it (all, if none does); each candidate
scores the word by its n-grams. Viterbi over the words of a text, with a penalty for every change
of language, labels the spans; the language with most letters labels the text, and the
score is the share of all letters that it labels in scripts it uses; so a text of a
script that no learned language uses gets the language its n-grams point to, with score 0.

Null text or text without a letter: ``und``, score 0, no spans; so is every text if
nothing was learned. Ties go to the language that sorts first. Documents without a language
do not teach; repeated rows teach again. An empty table gives an empty one; other columns do
not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stormledger.llm.shingles import _BYTE, _power_tables, mix

CELLS = 1 << 16
LONGEST_GRAM = 4
SMOOTHING = 0.5
SWITCH = 8.0  # nats that a change of language costs
SCRIPT_SHARE = 0.01  # a language uses a script if it has this share of its letters in it, or holds this share of the script's
TEXTS_AT_ONCE = 3000
CACHED_WORDS = 300_000  # a task forgets its words beyond this number; results do not depend on it
STATE = np.int32  # number of a language
_U = np.uint64

# FIXED VALUES: Unicode ranges of scripts
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x323AF),
]
SCRIPT_NAMES = [*dict.fromkeys(s for s, _, _ in SCRIPTS), "other"]
LAST_LATIN = "\u024f"
_STARTS = np.array([a for _, a, _ in SCRIPTS])
_ENDS = np.array([b for _, _, b in SCRIPTS])
_NUMBERS = np.array([SCRIPT_NAMES.index(s) for s, _, _ in SCRIPTS])
_NO_LETTERS = regex.compile(r"[^\p{L}]+")


def letters_of(chunk: str) -> str:
    return chunk if chunk.isascii() and chunk.isalpha() and chunk.islower() else _NO_LETTERS.sub("", chunk.lower())


def script_of(word: str) -> int:
    """Number of the script of most letters, the earlier one on a tie."""
    if max(word) <= LAST_LATIN:  # words are letters, and all letters up to here are Latin
        return 0
    points = np.array([ord(c) for c in word])
    at = np.searchsorted(_STARTS, points, "right") - 1
    own = np.where((at >= 0) & (points <= _ENDS[at]), _NUMBERS[at], len(SCRIPT_NAMES) - 1)
    return int(np.argmax(np.bincount(own, minlength=len(SCRIPT_NAMES))))


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams of the words, and the word of each."""
    spelled = [w.encode() for w in words]
    data = np.frombuffer(b" " + b" ".join(spelled) + b" ", np.uint8)
    lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
    starts = np.cumsum(lengths + 1) - lengths  # past the space before
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    cells, owners = [], []
    for size in range(1, LONGEST_GRAM + 1):
        edge = int(size > 1)  # single bytes have no edges
        count = np.maximum(lengths + 2 * edge - size + 1, 0)
        owner = np.repeat(np.arange(len(words)), count)
        at = (starts - edge)[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        cells.append(mix((sums[at + size] - sums[at]) * down[at] + _U(size)))
        owners.append(owner)
    cells.append(mix((sums[starts + lengths] - sums[starts]) * down[starts] + _U(99)))
    owners.append(np.arange(len(words)))
    return (np.concatenate(cells) >> _U(48)).astype(np.int64), np.concatenate(owners)


class Model:
    """Log probability of every cell in every language, and which scripts each language uses."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        self.logs = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * CELLS)).astype(np.float32)
        own, held = scripts / np.maximum(scripts.sum(axis=0), 1), scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = np.maximum(own, held) >= SCRIPT_SHARE  # script x language

    def scores(self, words: list[str], scripts: np.ndarray) -> np.ndarray:
        """Words x languages; the best candidate at 0, languages that do not use the script far below."""
        cells, owner = grams(words)
        n = np.maximum(np.bincount(owner, minlength=len(words)), 1)
        sums = np.stack([np.bincount(owner, weights=self.logs[cells, k], minlength=len(words)) for k in range(len(self.languages))], axis=1)
        sums /= np.sqrt(n)[:, None]
        uses = self.uses[scripts]
        uses |= ~uses.any(axis=1, keepdims=True)
        sums = np.where(uses, sums, sums.min(axis=1, keepdims=True) - 100.0)
        return (sums - sums.max(axis=1, keepdims=True)).astype(np.float32)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all documents that have a text and a language."""
    taught = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, chunks in held.items():
                words = Counter()
                for chunk, n in chunks.items():
                    if word := letters_of(chunk):
                        words[word] += n
                if not words:
                    continue
                spelled, times = list(words), np.fromiter(words.values(), np.int64, len(words))
                cells, owner = grams(spelled)
                sums = np.bincount(cells, weights=times[owner], minlength=CELLS)
                scripts = np.bincount([script_of(w) for w in spelled], weights=times * np.fromiter(map(len, spelled), np.int64, len(spelled)), minlength=len(SCRIPT_NAMES))
                sums = np.concatenate((sums, scripts)).astype(np.int64)
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])], ["lang", "cell", "n"])
            held.clear()

        for batch in batches:
            for value, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(value.split())
            if sum(map(len, held.values())) > CACHED_WORDS:
                yield from flush()
        yield from flush()

    summed = taught.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(summed["lang"].unique())
    table = np.zeros((CELLS + len(SCRIPT_NAMES), len(languages)))
    table[summed["cell"], np.searchsorted(languages, summed["lang"].to_numpy())] = summed["n"] if len(summed) else 0
    return Model(languages, table[:CELLS], table[CELLS:])


def best_paths(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word: texts in a row, ``sizes`` words each, all texts advanced together."""
    states = scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    active = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")  # texts longer than t
    came = np.empty(scores.shape, STATE)
    own = np.arange(states, dtype=STATE)
    value = np.zeros((int(active[0]) if len(active) else 0, states), np.float32)
    final = np.zeros(len(sizes), np.int64)
    for t, n in enumerate(active.tolist()):
        if n < len(value):
            final[n : len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        at = begins[:n] + t
        best = value.argmax(axis=1)
        jump = value[np.arange(n), best][:, None] - switch
        stay = value >= jump
        came[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, jump) + scores[at]
    final[: len(value)] = value.argmax(axis=1)
    path = np.empty(len(scores), STATE)
    state = final
    for t in range(len(active) - 1, -1, -1):
        at = begins[: active[t]] + t
        path[at] = state[: active[t]]
        state[: active[t]] = came[at, state[: active[t]]]
    return path


def label(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``key``, lang_pred, score and spans (array of lang, first_word, n_words) of each whole text.

    Words are runs without white space, numbered from 0; a span covers words of one
    label, those without a letter included.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        states = len(model.languages)
        place: dict[str, int] = {}
        table, letters, kinds = np.zeros((0, states), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(first, TEXTS_AT_ONCE)
                chunks = [t.split() if t else [] for t in part.column(1).to_pylist()]
                if len(place) > CACHED_WORDS:
                    place, table, letters, kinds = {}, table[:0], letters[:0], kinds[:0]
                new = [c for c in dict.fromkeys(c for own in chunks for c in own) if c not in place]
                place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
                words = [letters_of(c) for c in new]
                known = [k for k, w in enumerate(words) if w]
                more = np.zeros((len(new), states), np.float32)
                count, kind = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
                if known and states:
                    scripts = np.fromiter((script_of(words[k]) for k in known), np.int64, len(known))
                    more[known] = model.scores([words[k] for k in known], scripts)
                    count[known] = np.fromiter((len(words[k]) for k in known), np.int64, len(known))
                    kind[known] = scripts
                table, letters, kinds = np.concatenate((table, more)), np.concatenate((letters, count)), np.concatenate((kinds, kind))
                sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
                at = np.fromiter((place[c] for own in chunks for c in own), np.int64, int(sizes.sum()))
                yield _labelled(part.column(0), model, table[at], letters[at], kinds[at], sizes)

    def _labelled(keys: pa.Array, model: Model, scores: np.ndarray, letters: np.ndarray, scripts: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        languages = model.languages
        states, n = max(1, len(languages)), len(sizes)
        path = best_paths(scores, sizes, switch) if len(languages) else np.zeros(len(scores), STATE)
        owner = np.repeat(np.arange(n), sizes)
        held = np.bincount(owner * states + path, weights=letters, minlength=n * states).reshape(n, states)
        total, best = held.sum(axis=1), held.argmax(axis=1)
        if len(languages):  # letters of the label's own scripts
            own = letters * (path == best[owner]) * model.uses[scripts, path]
            share = np.bincount(owner, weights=own, minlength=n) / np.maximum(total, 1)
        else:
            share = np.zeros(n)
        named = np.array([*languages, "und"], object)
        found = np.where(total > 0, best, len(languages))
        cuts = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        cuts = cuts[total[owner[cuts]] > 0] if len(cuts) else cuts
        begins = np.cumsum(sizes) - sizes
        after = np.append(cuts[1:], len(path)) if len(cuts) else cuts
        after = np.minimum(after, (begins + sizes)[owner[cuts]]) if len(cuts) else after
        spans = pa.StructArray.from_arrays(
            [pa.array(named[path[cuts]], pa.string()), pa.array((cuts - begins[owner[cuts]]).astype(np.int32)), pa.array((after - cuts).astype(np.int32))],
            fields=list(span),
        )
        offsets = np.searchsorted(owner[cuts], np.arange(n + 1)) if len(cuts) else np.zeros(n + 1, int)
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(named[found], pa.string()), pa.array(share), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans)],
            ["key", "lang_pred", "score", "spans"],
        )

    kind = slim.schema["key"].dataType.simpleString()
    out = slim.mapInArrow(run, f"key {kind}, lang_pred string, score double, spans array<struct<lang: string, first_word: int, n_words: int>>")
    return out.select(F.col("key").alias(key), "lang_pred", "score", "spans")
