"""64-bit names of words and of word windows, in numpy, equal in every worker."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _splitmix(x: int) -> int:
    x = (x + _GOLDEN) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def factors(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit factors."""
    return np.array([_splitmix(seed * 1_000_003 + i) | 1 for i in range(n)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit names that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordNames(dict):
    """Name of each word (bytes), remembered up to a bound."""

    MOST = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        name = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class TwoNames(dict):
    """Two independent 64-bit names of each word (bytes), remembered up to a bound: of each its place in `digests`."""

    MOST = 300_000

    def __init__(self):
        self.digests = bytearray()

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.digests += blake2b(word, digest_size=16).digest()
        return at

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.MOST:
            self.clear()
            self.digests = bytearray()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        both = np.frombuffer(bytes(self.digests), dtype="<u8").reshape(-1, 2)
        return both[at, 0], both[at, 1]


def window_names(names: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Name of the window of `width` words that starts at each place (none at the last width - 1)."""
    n = len(names) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i, factor in enumerate(factors(width, seed)):
        total += names[i : i + n] * factor
    return mix(total)
