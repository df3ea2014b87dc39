"""The binary Golay code: 4,096 words of 23 bits, at least 7 apart, so that every word of 23 bits lies within 3 of one.

Two words that differ in one bit share a code word among their keys: a word within 2 of its code word has that one
alone, a word at distance 3 also the five at distance 4.  If the neighbour's code word is another one, both words lie
at distance 3 from their own and at distance 4 from the other's.
"""

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the cyclic code: a fixed value.
GENERATOR = 0b101011100011
BITS = 23
CHECKS = 11


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(BITS - 1, CHECKS - 1, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - CHECKS), 0)
    return words


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By remainder: the error of at most 3 bits, its weight, and the five code words of weight 7 that contain it."""
    code = np.arange(1 << 12, dtype=np.int64) << CHECKS
    code |= _remainder(code)
    heavy = code[np.bitwise_count(code) == 7]
    errors = [0] + [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(BITS), n)]
    error = np.zeros(1 << CHECKS, np.int64)
    beside = np.zeros((1 << CHECKS, 5), np.int64)
    for pattern, at in zip(errors, _remainder(np.array(errors, np.int64)), strict=True):
        error[at] = pattern
        if pattern.bit_count() == 3:
            beside[at] = heavy[(heavy & pattern) == pattern]
    return error, np.bitwise_count(error), beside


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word, index of a near code word of 12 bits), one entry for each key of each word."""
    error, weight, beside = tables()
    at = _remainder(words.astype(np.int64))
    own = words ^ error[at]
    deep = np.flatnonzero(weight[at] == 3)
    position = np.concatenate([np.arange(len(words)), np.repeat(deep, 5)])
    found = np.concatenate([own, (own[deep, None] ^ beside[at[deep]]).ravel()])
    return position, found >> CHECKS
