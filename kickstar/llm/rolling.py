"""Polynomial prefix hashes of byte or number sequences, in numpy (arithmetic modulo 2**64).

With prefix sums ``P[i] = x0 + x1 B + ... + x(i-1) B**(i-1)``, the hash of the part [s, e) is
``(P[e] - P[s]) / B**s``: the same for equal parts wherever they stand. ``B`` is odd, so it
can be divided by. The hashes only group candidates; callers compare contents."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)     # odd mixing constants


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Prefixes:
    """Prefix polynomials of sequences of any length; the powers are computed once and grow."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self._up = self._down = np.ones(1, np.uint64)

    def of(self, values: np.ndarray) -> np.ndarray:
        """``len(values) + 1`` prefix polynomials of unsigned 64-bit values."""
        n = len(values)
        if n + 1 > len(self._up):
            size = n + n // 4 + 1
            self._up, self._down = powers(self.base, size), powers(self.inverse, size)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self._up[:n], out=out[1:])
        return out

    def parts(self, prefixes: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        """Hashes of the parts [start, end)."""
        return mixed((prefixes[end] - prefixes[start]) * self._down[:len(prefixes)][start])
