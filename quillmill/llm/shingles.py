"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 5
_ORDER = np.random.default_rng(20_240_602).integers(0, 1 << 63, SIZE, dtype=np.uint64) * 2 + 1


#: Words of which a worker knows the numbers: those met of late, and as many before them.
STORED_WORDS = 100_000


class WordIds(dict):
    """64-bit number of each word; keeps the frequent ones when it forgets."""

    older: dict = {}

    def __missing__(self, word) -> int:
        if len(self) >= STORED_WORDS:
            self.older = self.copy()
            self.clear()
        number = self.older.get(word)
        number = self[word] = xxhash.xxh3_64_intdigest(word) if number is None else number
        return number


_IDS = WordIds()


def word_numbers(words: list) -> np.ndarray:
    return np.array(list(map(_IDS.__getitem__, words)), np.uint64)


def shingles(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Hash of every run of ``size`` words, in text order; none for shorter texts."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    mixed = np.full(n, np.uint64(size))
    for i in range(size):
        mixed = (mixed ^ words[i : i + n]) * _ORDER[i]
        mixed ^= mixed >> np.uint64(31)
    return mixed


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer words is one shingle, one of none is empty.

    Only A-Z are lowered, and only ASCII white space parts words.
    """
    words = word_numbers((text or "").encode("utf-8", "surrogatepass").lower().split())
    return np.unique(shingles(words, min(SIZE, len(words)))) if len(words) else words
