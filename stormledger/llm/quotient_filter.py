"""Counting quotient filters of packed n-grams, in numpy, for use inside Arrow tasks.

An n-gram of word ids is packed into a left and a right half of equal width. A
Feistel network permutes the packed value invertibly, so every value is equally
likely to stand anywhere and none is lost. The leading bits of the permuted value are
its quotient, all others its remainder. A filter lists its entries by permuted
value: one bit for each quotient that occurs (occupieds), one bit for each entry that
ends the run of its quotient (runends), the remainders in full, and the counters
in as many bytes as they need. Equal widths sort alike, so sorted filters of different
shards, cut to any quotient size, merge by their order.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ROUNDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], _U)


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers in seven bits a byte, lowest first; a byte's top bit says that more follow."""
    values = values.astype(_U)
    size = np.ones(len(values), np.int64)
    for k in range(1, 10):
        size += values >= _U(1) << _U(7 * k)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        here = size > k
        more = (size[here] > k + 1).astype(np.uint8) << 7
        out[at[here] + k] = ((values[here] >> _U(7 * k)) & _U(127)).astype(np.uint8) | more
    return out.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    held = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(held < 128)
    begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    size = ends - begins + 1
    out = np.zeros(len(ends), _U)
    for k in range(int(size.max(initial=0))):
        here = size > k
        out[here] |= (held[begins[here] + k].astype(_U) & _U(127)) << _U(7 * k)
    return out


class Permutation:
    """Invertible permutation of pairs of ``half``-bit numbers (at most 64 bits each)."""

    def __init__(self, half: int):
        self.half, self.mask = half, _U((1 << half) - 1)

    def _step(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
        return (x ^ (x >> _U(32))) & self.mask

    def forward(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in _ROUNDS:
            left, right = right, left ^ self._step(right, key)
        return left, right

    def back(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in _ROUNDS[::-1]:
            left, right = right ^ self._step(left, key), left
        return left, right


def summed(half: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values and their counts; ``counts`` None: each value once."""
    if not len(left):
        return left, right, np.zeros(0, np.int64)
    if 2 * half <= 64:
        whole = left << _U(half) | right
        order = np.argsort(whole, kind="stable")
        fresh = np.diff(whole[order], prepend=~whole[order[0]]) != 0
    else:
        order = np.lexsort((right, left))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)
    first = np.flatnonzero(fresh)
    if counts is None:
        total = np.diff(first, append=len(order))
    else:
        total = np.add.reduceat(counts[order], first)
    return left[order[first]], right[order[first]], total.astype(np.int64)


def encode(half: int, shard_bits: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
    """A filter of sorted distinct values that agree in their first ``shard_bits`` bits, which are left out."""
    n = len(left)
    bits = min(half - shard_bits, max(0, (n - 1).bit_length()))  # of the quotient
    rest = half - shard_bits - bits  # of the left half, beside the right half, in the remainder
    own = left & _U((1 << (half - shard_bits)) - 1)
    quotient = (own >> _U(rest)).astype(np.int64)
    occupied = np.zeros(1 << bits, bool)
    occupied[quotient] = True
    runends = np.append(np.diff(quotient) != 0, True)
    parts = [np.array([n, bits], np.uint32).tobytes(), np.packbits(occupied).tobytes(), np.packbits(runends).tobytes()]
    for values, width in ((own & _U((1 << rest) - 1), rest), (right, half)):
        planes = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-width // 8)]
        parts.append(np.ascontiguousarray(planes).tobytes())
    return b"".join(parts) + pack_numbers(counts - 1)


def decode(half: int, shard_bits: int, shard: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, bits = (int(x) for x in np.frombuffer(data, np.uint32, 2))
    at = 8

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << bits) // 8)), count=1 << bits))
    runends = np.unpackbits(take(-(-n // 8)), count=n)
    run = np.cumsum(runends) - runends
    rest = half - shard_bits - bits
    halves = []
    for width in (rest, half):
        planes = -(-width // 8)
        held = np.zeros((n, 8), np.uint8)
        held[:, :planes] = take(n * planes).reshape(n, planes)
        halves.append(held.view("<u8").ravel().astype(_U))
    lead = _U(shard << (half - shard_bits))
    left = lead | occupied.astype(_U)[run] << _U(rest) | halves[0]
    return left, halves[1], unpack_numbers(data[at:]).astype(np.int64) + 1


def merge(half: int, filters: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(filters) == 1:
        return filters[0]
    left, right, counts = (np.concatenate(c) for c in zip(*filters, strict=True))
    return summed(half, left, right, counts)


class Merger:
    """Sorted filters of one shard, merged as they come: those of like size with one another."""

    def __init__(self, half: int):
        self.half, self.held = half, []

    def add(self, one: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.held.append(one)
        while len(self.held) > 1 and len(self.held[-2][0]) <= 2 * len(self.held[-1][0]):
            last = self.held.pop()
            self.held.append(merge(self.half, [self.held.pop(), last]))

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return merge(self.half, self.held)
