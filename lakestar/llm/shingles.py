"""Hashes of words and of runs of words, as numpy arrays, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MASK = (1 << 64) - 1


class WordHashes(dict):
    """64 bit hashes of words; remembers the words it has met, up to a bound."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = got
        return got

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return mixed(out)


def lowered_words(text: bytes | None) -> list[bytes]:
    """Words between white space, A-Z lowered."""
    return (text or b"").lower().split()


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Runs of ``size`` words; a shorter text with a word is one run."""
    return runs(hashes, min(size, len(hashes))) if len(hashes) else np.empty(0, np.uint64)
