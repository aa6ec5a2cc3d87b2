"""Word sequences as arrays of 64-bit hashes, a slice of rows at a time."""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import xxhash

LIMIT = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes:
    """Hashes of words, kept for frequent words while the process lives."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            digest = xxhash.xxh3_64_intdigest
            new = {w: digest(w) for w, h in zip(words, found) if h is None}
            found = [new[w] if h is None else h for w, h in zip(words, found)]
            if len(self.known) < LIMIT:
                self.known.update(new)
        return np.array(found, np.uint64)


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def flat(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the ends of the lists among them."""
    ends = np.cumsum([len(x) for x in lists]).astype(np.int64)
    return word_hashes().of(list(chain.from_iterable(lists))), ends


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A hash for each run of ``n`` words, by the place of its first word."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, seed, np.uint64)
    for k in range(n):
        out = mix(out * _ODD + hashes[k : k + count])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
