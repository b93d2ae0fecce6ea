"""The perfect binary Golay code [23, 12, 7]: every 23-bit word lies within three bits
of exactly one codeword, so decoding a word and the words one bit away from it names
all codewords that a word at distance one could decode to."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Fixed value of the code: its generator polynomial x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
BITS = 23


def _remainder(words: np.ndarray) -> np.ndarray:
    """The 11-bit syndrome: a word modulo the generator polynomial."""
    left = words.astype(np.int64).copy()
    for bit in range(BITS - 1, 10, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


@cache
def _leaders() -> np.ndarray:
    """The error pattern of up to three bits that each syndrome stands for."""
    one = [1 << i for i in range(BITS)]
    patterns = np.array([0, *one, *(a | b for a in one for b in one if a < b),
                         *(a | b | c for a in one for b in one if a < b for c in one if b < c)], dtype=np.int64)
    table = np.zeros(1 << 11, dtype=np.int64)
    table[_remainder(patterns)] = patterns
    return table


@cache
def _index() -> np.ndarray:
    """The 12-bit index of the codeword nearest to each of the 2^23 words."""
    words = np.arange(1 << BITS, dtype=np.int64)
    return ((words ^ _leaders()[_remainder(words)]) >> 11).astype(np.uint16)


def decode(words: np.ndarray) -> np.ndarray:
    """Codeword index of each word."""
    return _index()[words]


def nearby(words: np.ndarray, bits: int) -> np.ndarray:
    """A row for each word: the codeword indices of the word itself and of each word
    that differs from it in one of its ``bits`` low bits (repeats included)."""
    flips = np.array([0, *(1 << i for i in range(bits))], dtype=np.int64)
    return _index()[words[:, None] ^ flips]
