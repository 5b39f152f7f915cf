"""Counts over whole texts, a slice of texts at a time, by numpy over code points."""

from __future__ import annotations

import numpy as np

#: Class of each code point below 256, as bits.
SPACE, UPPER, LOWER, DIGIT, PUNCT, EXCLAIM, SYMBOL, BREAK, PIPE, STOP = (1 << k for k in range(10))


def _table() -> np.ndarray:
    table = np.zeros(0x250, dtype=np.uint16)
    for c in range(0x250):
        s = chr(c)
        table[c] |= SPACE * (s in " \t\n\v\f\r") | UPPER * s.isupper() | LOWER * (s.islower() or (s.isalpha() and not s.isupper())) | DIGIT * (s in "0123456789")
        table[c] |= PUNCT * (s in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") | EXCLAIM * (s in "!?") | SYMBOL * (s in "#*$%&|<>@^~") | BREAK * (s == "\n") | PIPE * (s in "|\t") | STOP * (s in ".,;:")
    return table


_TABLE = _table()


def classes(text: str) -> np.ndarray:
    """Class bits of every code point; beyond the table everything counts as a lower-case letter."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(chars < len(_TABLE), _TABLE[np.minimum(chars, len(_TABLE) - 1)], LOWER).astype(np.uint16)


def sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Set flags in each [start, end)."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends] - total[starts]
