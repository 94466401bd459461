"""Polynomial hashes of token runs, all modulo 2^64, computed for whole arrays at once.

``Prefix`` keeps the sums of ``token[i] * B**i``. The hash of a run is the difference of two prefix
sums times the inverse of ``B**start``, so equal runs have equal hashes wherever they start.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits, so that order by value is order at random."""
    x = x ^ (x >> U64(31))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(29)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(32)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse for i up to n."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            factors = np.full(size, b, U64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        have = _powers[base] = (both[0], both[1])
    return have


class Prefix:
    """Prefix hashes of a token sequence."""

    def __init__(self, tokens: np.ndarray, base: int = BASES[0]):
        power, self.inverse = powers(base, len(tokens) + 1)
        self.sums = np.zeros(len(tokens) + 1, U64)
        np.cumsum(tokens * power[:len(tokens)], out=self.sums[1:])

    def runs(self, length: int) -> np.ndarray:
        """Hash of the run of ``length`` tokens at every place where one fits."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, U64)
        return (self.sums[length:] - self.sums[:n]) * self.inverse[:n]

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each stretch of ``width`` values."""
    if len(values) < width:
        return values[:0]
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    prefix = Prefix(BYTE_VALUES[data])
    return mix(prefix.between(starts, stops) + (stops - starts).astype(U64))


def spread_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
