"""Byte-pair encoding and decoding with a given vocabulary file.

Texts are split at white space into chunks; a chunk's tokens do not depend on
its neighbours, so a task encodes each distinct chunk once. All new words of a
batch are merged together over a pair occurrence index: every pair of adjacent
symbols maps to all its positions, active ranks are applied in ascending order,
and each merge updates the lists of the pairs beside it.

Null text counts as empty. Rows keep their other columns out: results carry the
key column only, also where other columns have clashing names. Repeated rows
give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

GROUP_BYTES = 1 << 20  # of the texts that a task learns and encodes together
CACHE_BYTES = 24 << 20  # a task forgets its chunks beyond this size; results do not depend on it
CHUNK_BYTES = 130  # what a chunk takes beside its letters and tokens
ROWS_AT_ONCE = 200
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # str.split() splits here, the vocabulary's pattern does not
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_COMMON = re.compile("[\x00-ɏ]*")  # beyond it Unicode versions differ: the file's own components decide


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Merges, token numbers and split pattern of a tokenizer file whose words end in a suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.merges = [
            (self.ids[left], self.ids[right], self.ids[left + right])
            for left, right in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        ]
        asked = np.array([left << 32 | right for left, right, _ in self.merges])
        self.pairs, self.ranks = np.unique(asked, return_index=True)
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words, self.marked = regex.compile(pattern), regex.compile(pattern + "|\n")
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        self.inner = np.array([self.ids[c] for c in letters])
        self.final = np.array([self.ids[c + self.suffix] for c in letters])
        self.library = Tokenizer.from_file(path)

    def split(self, chunk: str) -> list[bytes]:
        """Words of one chunk without special tokens, normalised."""
        if _COMMON.fullmatch(chunk):
            return [w.encode() for w in self.words.findall(unicodedata.normalize("NFC", chunk).lower())]
        text = self.library.normalizer.normalize_str(chunk)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(text)
        spelled = text.encode()
        out, at = [], 0
        for piece, _ in pieces:  # a piece has a letter for each byte; pieces leave out nothing but white space
            size = len(piece)
            while spelled[at : at + 1] == b" ":
                at += 1
            out.append(spelled[at : at + size])
            at += size
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in a row and the number of tokens of each word.

        ``places`` is the pair occurrence index: for each active rank all positions
        where its pair stands. A merge drops the pair's list and adds the new
        neighbours' positions to theirs.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        spelled = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[spelled]
        symbols[ends - 1] = self.final[spelled[ends - 1]]
        size = len(symbols)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            ranks = self.rank_of(symbols[at], symbols[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for rank, a, b in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(at)], strict=True):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(at[a:b])

        note(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            left, right, joined = self.merges[rank]
            at = np.unique(np.concatenate(places.pop(rank)))
            at = at[(symbols[at] == left) & (after[at] >= 0)]
            at = at[symbols[after[at]] == right]  # else an earlier merge used one of the two
            if left == right and len(at) > 1:  # in a run of equal symbols, the first two, the next two, ...
                chained = np.concatenate(([False], after[at[:-1]] == at[1:]))
                run = np.cumsum(~chained)
                at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbols[at], symbols[gone] = joined, -1
            after[at] = follow = after[gone]
            inner = follow >= 0
            before[follow[inner]] = at[inner]
            lead = before[at]
            note(np.concatenate((lead[lead >= 0], at[inner])))
        alive = symbols >= 0
        counts = np.add.reduceat(alive, ends - lengths, dtype=np.int64) if len(words) else np.zeros(0, np.int64)
        return symbols[alive].astype(np.int32), counts

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        asked = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, asked), len(self.pairs) - 1)
        return np.where(self.pairs[at] == asked, self.ranks[at], -1)

    def encode_chunks(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The chunks in a new order, all their tokens in a row, the number of tokens of each chunk."""
        plain = [c for c in chunks if "<|" not in c and _COMMON.fullmatch(c)]
        items: list[bytes | int] = []
        sizes: list[int] = []
        if plain:
            found = self.marked.findall(unicodedata.normalize("NFC", "\n".join(plain)).lower())
            items = [w.encode() for w in found if w != "\n"]
            marks = np.flatnonzero(np.fromiter((w == "\n" for w in found), bool, len(found)))
            sizes = (np.diff(marks, prepend=-1, append=len(found)) - 1).tolist()
        others = [] if len(plain) == len(chunks) else [c for c in chunks if "<|" in c or not _COMMON.fullmatch(c)]
        for chunk in others:
            before = len(items)
            for part in self.specials.split(chunk):
                if part in self.special:
                    items.append(self.special[part])
                elif part:
                    items.extend(self.split(part))
            sizes.append(len(items) - before)
        distinct = list(dict.fromkeys(items))
        words = [w for w in distinct if isinstance(w, bytes)]
        specials = [w for w in distinct if isinstance(w, int)]
        tokens, counts = self.merge(words)
        tokens = np.concatenate((tokens, np.array(specials, np.int32)))
        counts = np.concatenate((counts, np.ones(len(specials), np.int64)))
        place = {w: k for k, w in enumerate([*words, *specials])}
        used = np.fromiter(map(place.__getitem__, items), np.int64, len(items))
        lengths = counts[used]
        total = np.concatenate(([0], np.cumsum(lengths)))
        edges = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
        return plain + others, gather(tokens, (np.cumsum(counts) - counts)[used], lengths), np.diff(total[edges])


def gather(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[b : b + n]`` for each b and n, in a row."""
    total = np.cumsum(lengths)
    shift = np.repeat(begins - total + lengths, lengths)
    return values[shift + np.arange(len(shift))]


class Encoder:
    """Tokens of every distinct chunk that a task has met."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.place, self.held = vocab, {}, 0
        self.tokens, self.begins, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, texts: list[str | None]) -> None:
        if self.held > CACHE_BYTES:
            self.__init__(self.vocab)
        new: dict[str, None] = {}
        for text in texts:
            if text:
                new.update((c, None) for c in _chunks(text) if c not in self.place)
        if new:
            chunks, tokens, lengths = self.vocab.encode_chunks(list(new))
            self.held += sum(map(len, chunks)) + 4 * len(tokens) + CHUNK_BYTES * len(chunks)
            self.place.update(zip(chunks, range(len(self.place), len(self.place) + len(chunks)), strict=True))
            begins = np.cumsum(lengths) - lengths + len(self.tokens)
            self.tokens = np.concatenate((self.tokens, tokens))
            self.begins, self.lengths = np.concatenate((self.begins, begins)), np.concatenate((self.lengths, lengths))

    def token_lists(self, texts: list[str | None]) -> pa.Array:
        sizes, used = np.zeros(len(texts), np.int64), []
        for k, text in enumerate(texts):
            if text:
                chunks = _chunks(text)
                sizes[k] = len(chunks)
                used.append(np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks)))
        places = np.concatenate(used) if used else np.zeros(0, np.int64)
        lengths = self.lengths[places]
        total = np.concatenate(([0], np.cumsum(lengths)))
        offsets = total[np.concatenate(([0], np.cumsum(sizes)))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(gather(self.tokens, self.begins[places], lengths)))


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _chunks(text: str) -> list[str]:
    if any(c in text for c in _SEPARATORS):
        return [c for c in _WHITE.split(text) if c]
    return text.split()


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of consecutive texts of about ``most`` bytes together; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, first = np.concatenate(([0], np.cumsum(sizes))), 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(total, total[first] + most, "right")) - 1)
        yield first, last
        first = last


def encode(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key`` and ``ids`` (array of int): the tokens of each whole text, no special ones added.

    Null or empty text: an empty array. Strings of special tokens inside a text
    become those tokens, as the vocabulary's library has it. With ``decoded``, also the
    text that ``decode`` gives, in the same pass. Texts are taken and handed on in groups
    of bounded size.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    names_of = ["key", "ids", "decoded"] if decoded else ["key", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(vocab_path))
        names = token_names(encoder.vocab)
        for batch in batches:
            for a, z in groups(batch.column(1)):
                texts = batch.column(1).slice(a, z - a).to_pylist()
                encoder.learn(texts)
                lists = encoder.token_lists(texts)
                more = [_joined(lists, names)] if decoded else []
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), lists, *more], names_of)

    fields = [T.StructField("key", slim.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    schema = T.StructType(fields + [T.StructField("decoded", T.StringType())] * decoded)
    return slim.mapInArrow(run, schema).select(F.col("key").alias(key), *names_of[1:])


def token_names(vocab: Vocabulary) -> pa.Array:
    return pa.array([n or None for n in vocab.names])


def decode(tokens: DataFrame, vocab_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and ``decoded``: the token strings joined by one space, special ones included.

    The vocabulary has no decoder of its own, so token strings appear as they are
    listed. Null or empty ``ids``: empty text. Unknown numbers are left out.
    """
    slim = tokens.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(vocabulary(vocab_path))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _joined(part.column(1), names)], ["key", "ids", "decoded"])

    schema = T.StructType([*slim.schema.fields, T.StructField("decoded", T.StringType())])
    return slim.mapInArrow(run, schema).select(F.col("key").alias(key), "ids", "decoded")


def _joined(lists: pa.Array, names: pa.Array) -> pa.Array:
    values = lists.flatten()
    known = pc.and_(pc.greater_equal(values, 0), pc.less(values, len(names)))
    spelled = names.take(pc.if_else(known, values, None))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    if spelled.null_count:
        keep = spelled.is_valid().to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets].astype(np.int32)
        spelled = spelled.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), spelled), " ")
