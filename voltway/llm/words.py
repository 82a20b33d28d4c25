"""Word hashes and rolling hashes of word k-grams."""

from __future__ import annotations

import numpy as np
import xxhash

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


class WordHashes(dict):
    """word -> hash, made when first asked for; emptied by ``of`` beyond ``most`` words."""

    most = 250_000

    def __missing__(self, word: bytes) -> int:
        found = self[word] = word_hash(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive words, other for each k."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    found = np.full(n, k, np.uint64)
    for j in range(k):
        found = found * FACTOR + hashes[j : j + n]
    found ^= found >> np.uint64(29)
    return (found * FACTOR).view(np.int64)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of each 64-bit value."""
    z = x.astype(np.uint64) + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
