"""The binary Golay code of length 23: indices of the codewords near a word, by tables over its 2048 syndromes."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator polynomial."""
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= ((left >> bit) & 1) * (GENERATOR << (bit - 11))
    return left


@lru_cache(maxsize=1)
def near_errors() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of at most 4 bits that have it: an array (2048, 6) and how many count.

    The first is the only one of at most 3 bits (the code is perfect); if it has 3 bits, five of 4 bits follow.
    """
    patterns = [sum(1 << b for b in bits) for k in range(5) for bits in combinations(range(23), k)]
    of = syndrome(np.array(patterns))
    table, count = np.zeros((2048, 6), dtype=np.int64), np.zeros(2048, dtype=np.int64)
    for s, e in zip(of.tolist(), patterns, strict=True):
        if not (count[s] and e.bit_count() == 4 and int(table[s, 0]).bit_count() < 3):
            table[s, count[s]] = e
            count[s] += 1
    return table, count


def index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within 3 bits of each word."""
    table, _ = near_errors()
    return (words ^ table[syndrome(words), 0]) >> 11


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all codewords within 4 bits of each word, and which of the six columns count.

    Words that differ in at most one bit: each one's index() is among the other's near_indices().
    """
    table, count = near_errors()
    s = syndrome(words)
    return (words[:, None] ^ table[s]) >> 11, np.arange(6) < count[s][:, None]
