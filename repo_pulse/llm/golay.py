"""Fuzzy hash keys from the perfect binary Golay code [23, 12, 7].

Every 23-bit word lies within 3 bits of exactly one codeword. A word's keys
are that codeword's 12-bit index and, for words at distance exactly 3, also
the indices of the five codewords at distance 4 (six keys). Two words that
differ in at most 2 bits always share a key (checked over all cases in the
tests; by linearity words near the zero codeword suffice).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
BITS, PARITY = 23, 11


def _parity(message: np.ndarray) -> np.ndarray:
    """Remainder of message * x^11 divided by the generator."""
    rest = message.astype(np.int64) << PARITY
    for shift in range(BITS - PARITY - 1, -1, -1):
        rest = np.where((rest >> (shift + PARITY)) & 1, rest ^ (GENERATOR << shift), rest)
    return rest


PARITY_OF = _parity(np.arange(1 << (BITS - PARITY)))
CODEWORDS = (np.arange(1 << (BITS - PARITY)) << PARITY) | PARITY_OF


def syndrome(word: np.ndarray) -> np.ndarray:
    return PARITY_OF[word >> PARITY] ^ (word & ((1 << PARITY) - 1))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: index offsets of the keys relative to the word's message part, and how many."""
    seven = CODEWORDS[np.bitwise_count(CODEWORDS) == 7]
    offsets = np.zeros((1 << PARITY, 6), np.int64)
    count = np.ones(1 << PARITY, np.int64)
    for weight in range(4):
        for at in combinations(range(BITS), weight):
            error = sum(1 << i for i in at)
            s = int(syndrome(np.int64(error)))
            offsets[s, 0] = error >> PARITY
            if weight == 3:  # codewords at distance 4 hold all three error positions
                near = seven[(seven & error) == error]
                offsets[s, 1:] = (near >> PARITY) ^ (error >> PARITY)
                count[s] = 6
    return offsets, count


OFFSETS, COUNT = _tables()


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) codeword indices of 23-bit words, and how many of each row's count."""
    words = np.asarray(words, np.int64)
    s = syndrome(words)
    return (words >> PARITY)[:, None] ^ OFFSETS[s], COUNT[s]
