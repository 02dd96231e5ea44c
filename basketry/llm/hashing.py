"""Word and shingle hashes in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

U64 = np.uint64
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A published 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def split_words(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased words between ASCII white space; bytes methods touch nothing else."""
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), U64, len(words))


def shingle_set(text: bytes | None, width: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of all runs of ``width`` words; a shorter text is one run."""
    h = word_hashes(split_words(text))
    n = len(h)
    if n == 0:
        return h
    span = min(n, width)
    s = np.zeros(n - span + 1, U64)
    for i in range(span):
        s += h[i : n - span + 1 + i] * _STEPS[i % 5] * U64(2 * (i // 5) + 1)
    return np.unique(mix(s + U64(span)))


def slot(h: np.ndarray, count: int) -> np.ndarray:
    """Hashes spread evenly over ``0 .. count - 1``, rising with the hash."""
    return ((h >> U64(32)) * U64(count)) >> U64(32)
