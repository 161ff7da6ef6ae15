"""Hashed character n-grams of whole texts, in numpy.

Letters are lower-cased one by one and every run of other characters counts as one space, so that an
n-gram sees word starts and ends but no digits, punctuation or layout.
"""

from __future__ import annotations

import functools

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, or to a space for what is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def letter_codes(text: str) -> np.ndarray:
    """Code points of the letters of a text, its other runs as single spaces, one space around."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.concatenate(([32], _letters()[codes], [32]))
    space = codes == 32
    return codes[np.concatenate(([True], ~(space[1:] & space[:-1])))]


def hashed_grams(text: str, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """The n-grams of the given ascending sizes, repeats included, as numbers below 2 ** bits."""
    codes = letter_codes(text).astype(np.uint64)
    if len(codes) <= 2 and not (codes != 32).any():
        return np.empty(0, dtype=np.int64)
    found = []
    state = (codes + np.uint64(1)) * _MIX
    for n in range(1, sizes[-1] + 1):
        if n > 1:
            if len(state) < 2:
                break
            state = (state[:-1] ^ (state[:-1] >> np.uint64(29))) * _MIX + codes[n - 1 :]
        if n in sizes:
            mixed = (state ^ (state >> np.uint64(32))) * _MIX
            found.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)
