"""The binary Golay code of length 23: nearby codewords of words, by coset.

The code is perfect: every word of 23 bits lies within distance 3 of exactly one codeword.
A word at distance 3 has five more codewords at distance 4, a nearer word has none. Two words
that differ in one bit share a key in this way: the nearest codeword of one is
within distance 4 of the other.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
# One key from the nearest codeword, or six with those at distance 4.
MOST_KEYS = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the upper and the lower part of a word; error patterns of each remainder.

    Patterns stand by weight; the first is the one of weight 3 or less. A missing pattern
    is -1.
    """
    of_bit = [_remainder(1 << bit) for bit in range(LENGTH)]
    lower = np.array([_xor(of_bit, n) for n in range(1 << 12)], dtype=np.int64)
    upper = np.array([_xor(of_bit[12:], n) for n in range(1 << 11)], dtype=np.int64)
    patterns = np.full((1 << CHECK_BITS, MOST_KEYS), -1, dtype=np.int64)
    filled = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            rest = 0
            for place in places:
                rest ^= of_bit[place]
            if weight == 4 and (filled[rest] == 0 or int(patterns[rest, 0]).bit_count() < 3):
                raise AssertionError("not a perfect code")
            patterns[rest, filled[rest]] = sum(1 << place for place in places)
            filled[rest] += 1
    return upper, lower, patterns


def _xor(of_bit: list[int], number: int) -> int:
    total = 0
    for bit, value in enumerate(of_bit):
        if number >> bit & 1:
            total ^= value
    return total


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices (upper 12 bits) of the codewords near each word, nearest first, -1 for none."""
    upper, lower, patterns = tables()
    near = patterns[upper[words >> 12] ^ lower[words & 0xFFF]]
    return np.where(near < 0, -1, (words[:, None] ^ near) >> CHECK_BITS)
