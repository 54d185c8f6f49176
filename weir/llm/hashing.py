"""Hashes over arrays, for use in tasks."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well spread 64-bit value for each 64-bit value."""
    x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    """A random value for each byte."""
    return mix(np.arange(256, dtype=np.uint64), seed)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2^64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefixes:
    """Hashes of slices of byte strings of up to ``most`` bytes."""

    def __init__(self, most: int, seed: int = 0):
        self.values = byte_values(seed)
        self.up, self.down = powers(BASE, most), powers(INVERSE, most)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def slices(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One value per slice, the same for the same bytes; not yet mixed."""
        return (sums[end] - sums[start]) * self.down[start]
