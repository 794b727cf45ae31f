"""64-bit hashes of lower-cased words and of word n-grams, with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

TABLE_WORDS = 200_000  # words kept by a worker; beyond it the table starts anew, the hashes stay the same


class _Table(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Table()


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the distinct runs of ``words`` words, sorted; a shorter text is one run, no words none."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(words, n)
    run = np.full(n - size + 1, size, dtype=np.uint64)
    for i in range(size):
        run = mix(run + hashes[i:n - size + 1 + i])
    return np.unique(run)
