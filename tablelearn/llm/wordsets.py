"""Hashed word shingles of whole texts, computed in Arrow batches inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from tablelearn.llm.common import WordCache, worker_cache

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words: A-Z lower-cased, split at space and U+0009 to U+000D
    (what ``bytes.lower`` and ``bytes.split`` do)."""
    if not text:
        return np.empty(0, np.uint64)
    cache = worker_cache("word_hashes", lambda: WordCache(xxhash.xxh3_64_intdigest))
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if there are fewer."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            out = mix(out + _STEP + hashes[k : n - width + 1 + k])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingles(word_hashes(text), size))
