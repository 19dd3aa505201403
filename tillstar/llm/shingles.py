"""Words, word hashes and word shingles of whole texts, for use inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
#: Odd multipliers that give each place in a shingle its own weight; drawn once from a fixed seed.
PLACES = np.random.default_rng(5).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """Word to 64-bit hash. Emptied when full, so memory stays bounded; only speed depends on it."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words of A-Z-lowered text; bytes.split() parts at exactly space and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of one text.

    Fewer words than ``width`` make one shingle of the whole sequence, which also
    hashes its length, so it never equals a shingle of full width. No words: none.
    """
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    if n < width:
        return mixed((hashes * PLACES[:n]).sum(keepdims=True) + PLACES[32 + n])
    total = hashes[: n - width + 1] * PLACES[0]
    for k in range(1, width):
        total += hashes[k : n - width + 1 + k] * PLACES[k]
    return np.unique(mixed(total))
