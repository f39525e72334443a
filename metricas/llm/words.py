"""Words and word n-grams of many texts at once, as 64-bit numbers (numpy).

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Its number is a polynomial over random byte values
modulo 2**64, computed from prefix sums, then mixed; an n-gram's number is a
weighted sum of its words' numbers, mixed again.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

RADIX = 0x9E3779B97F4A7C15
RADIX_INVERSE = pow(RADIX, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor-shift and multiply)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd numbers made from a seed."""
    return mix(np.arange(1, n + 1, dtype=U) * U(RADIX) + U(seed)) | U(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base), U)
    if n:
        out[0] = 1
        np.cumprod(out, out=out)
    return out


class Words:
    """The words of consecutive texts: ``starts``/``ends`` in bytes, ``offs`` in words per text."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data = data
        n = len(data)
        solid = np.empty(n + 1, bool)
        solid[:n] = ~WHITE[data]
        solid[n] = False
        new = np.zeros(n + 1, bool)  # a text begins here
        new[offs[:-1]] = True
        new[n] = True
        begins = solid[:n].copy()
        begins[1:] &= ~solid[:n - 1] | new[1:n]
        ends = solid[:n] & (~solid[1:] | new[1:])
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.offs = np.searchsorted(self.starts, offs)

    def counts(self) -> np.ndarray:
        return np.diff(self.offs)

    def rows(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.offs) - 1), self.counts())

    def numbers(self, seed: int = 1, lower: bool = False) -> np.ndarray:
        """A 64-bit number for each word, equal for equal words."""
        if not len(self.starts):
            return np.zeros(0, U)
        values = constants(256, seed)
        data = LOWER[self.data] if lower else self.data
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(values[data] * powers(RADIX, len(data)), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * powers(RADIX_INVERSE, len(data) + 1)[self.starts]
        return mix(raw + (self.ends - self.starts).astype(U) * U(RADIX))


def ngrams(numbers: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Numbers of the n-grams that start at each word, ignoring where texts end."""
    m = len(numbers) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    total = np.zeros(m, U)
    for k, c in enumerate(constants(n, seed)):
        total += numbers[k:k + m] * c
    return mix(total)


def inside(offs: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the n-grams that start at each of the first total-n+1 words lie in one text."""
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    left = np.repeat(offs[1:], np.diff(offs))[:m] - np.arange(m)
    return left >= n
