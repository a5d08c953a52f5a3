"""Word shingles of whole texts as sorted 64-bit names, and their minima."""

from __future__ import annotations

import numpy as np
import xxhash

_GAP = 0x9E3779B97F4A7C15


class WordNames(dict):
    """64-bit name of a word; emptied when it has grown, as names follow from the word alone."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        name = self[word] = xxhash.xxh3_64_intdigest(word)
        return name


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; bytes methods know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_names(words: list[bytes], width: int, names: WordNames) -> np.ndarray:
    """Distinct shingles, sorted. Fewer words than ``width``: the whole sequence as one."""
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(names.__getitem__, words), np.uint64, len(words))
    taken = min(width, len(words))
    joined = np.full(len(words) - taken + 1, taken * _GAP % 2**64, np.uint64)
    for i in range(taken):
        joined = mix(joined + each[i : i + len(joined)])
    return np.unique(joined)


def hash_keys(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed keys of ``count`` hash functions (x ^ s) * m."""
    base = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(_GAP) + np.uint64(seed))
    return base[:count], base[count:] | np.uint64(1)


def minima(shingles: np.ndarray, keys: tuple[np.ndarray, np.ndarray], rows: int = 256):
    """Smallest value of each hash function over all shingles."""
    salt, factor = keys
    least = np.full(len(salt), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), rows):
        part = (shingles[start : start + rows, None] ^ salt) * factor
        np.minimum(least, part.min(axis=0), out=least)
    return least
