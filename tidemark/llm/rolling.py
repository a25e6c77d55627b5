"""Rolling hashes over words, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0xD6E8FEB86659FD93


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finish."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def roll(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words, by doubling; empty if there are fewer."""
    if len(hashes) < n:
        return hashes[:0]
    power, size, block = hashes, 1, None
    have = 0
    while True:
        if n & size:
            if block is None:
                block, have = power, size
            else:
                rest = power[have:]
                block = block[: len(rest)] * np.uint64(pow(_BASE, size, 1 << 64)) + rest
                have += size
        if size * 2 > n:
            return mix(block)
        power = power[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size:]
        size *= 2


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every run of ``n`` values, by doubling."""
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - n + size], x[n - size :]) if n > size else x
