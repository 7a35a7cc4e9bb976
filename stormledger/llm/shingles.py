"""Word hashes and word shingles of whole texts, in numpy, for use inside Arrow tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return, with A-Z lower-cased. Hashes have 64 bits: within one
text of n shingles two different ones meet with probability below n*n / 2**65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5  # words of a shingle
SLICE_BYTES = 1 << 20  # texts are worked on in slices of about this size, never cut

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * _U(2) + _U(1)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and the n + 1 offsets of the texts in them."""
    texts = texts.cast(pa.string()) if texts.type != pa.string() else texts
    texts = texts.fill_null("") if texts.null_count else texts
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last + 1, bytes, offsets) of consecutive texts of about ``most`` bytes together."""
    data, offsets = text_bytes(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (n + 1 entries)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_SPACE[data]
    fresh = np.zeros(len(data) + 1, bool)  # a text begins here
    fresh[offsets] = True
    starts = np.flatnonzero(inside[:-1] & (fresh[:-1] | ~np.concatenate(([False], inside[:-2]))))
    ends = np.flatnonzero(inside[:-1] & (fresh[1:] | ~inside[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[_LOWER[data] if fold else data] * up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    Fewer than five words make one shingle of them all; no word makes none.
    """
    for _, _, data, offsets in slices(texts):
        starts, ends, first = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        full = max(0, len(words) - WORDS + 1)
        runs = np.zeros(full, _U)
        for k in range(WORDS):
            runs += words[k : k + full] * _PLACE[k]
        runs = mix(runs)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= WORDS:
                yield np.unique(runs[a : b - WORDS + 1])
            elif b > a:
                short = (words[a:b] * _PLACE[: b - a]).sum(dtype=_U) + _U(b - a)
                yield mix(np.array([short], _U) ^ _U(0xA5A5A5A5DEADBEEF))
            else:
                yield np.zeros(0, _U)


def set_key(hashes: np.ndarray) -> int:
    """64-bit signed key of a set: equal sets have equal keys; 0 for the empty set."""
    if not len(hashes):
        return 0
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True) or 1
