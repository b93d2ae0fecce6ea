"""Deterministic pseudo-randomness from column hashes (ops C1, D8, D11).

``rand``/``randn`` depend on partitioning and task order; a hash of the row's
key does not, so reruns and retried tasks give the same numbers. The hash is the
MD5 of the key's text, which any SQL engine can repeat: its first 13 hex digits
make one uniform number, the next 13 a second, independent one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13  # 52 bits: exact in a double
_SPAN = float(1 << 52)


def key_hash(*cols, salt: str = "") -> Column:
    """Hex MD5 of the columns' text (nulls left out) and the salt, joined by ``|``."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *texts, F.lit(salt)).cast("binary"))


def _unit(digest: Column, part: int) -> Column:
    n = F.conv(F.substring(digest, 1 + part * _DIGITS, _DIGITS), 16, 10).cast("long")
    return (n + F.lit(0.5)) / F.lit(_SPAN)


def uniform01(*cols, salt: str = "") -> Column:
    """U(0,1) from the key's hash; never exactly 0."""
    return _unit(key_hash(*cols, salt=salt), 0)


def uniform(low: float, high: float, *cols, salt: str = "") -> Column:
    return F.lit(low) + F.lit(high - low) * uniform01(*cols, salt=salt)


def uniform_int(low: int, high: int, *cols, salt: str = "") -> Column:
    """Integer in [low, high)."""
    return (F.lit(low) + F.floor(uniform01(*cols, salt=salt) * F.lit(float(high - low)))).cast("int")


def standard_normal(*cols, salt: str = "") -> Column:
    """N(0,1) by Box-Muller on the two uniforms of one hash."""
    digest = key_hash(*cols, salt=salt)
    return F.sqrt(F.lit(-2.0) * F.log(_unit(digest, 0))) * F.cos(F.lit(2 * math.pi) * _unit(digest, 1))


# --- the same numbers for many keys at once, inside a task ---------------------

_SHIFTS = (7, 12, 17, 22) * 4 + (5, 9, 14, 20) * 4 + (4, 11, 16, 23) * 4 + (6, 10, 15, 21) * 4
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_BLOCK, _LENGTH = 64, 8  # bytes of an MD5 block, and of the length at its end
_WORD = 4


def _one_block_md5(words: np.ndarray) -> list[np.ndarray]:
    """MD5 of padded messages of one block each (16 words x messages), as four big-endian 32-bit numbers."""
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(words.shape[1], x) for x in start)
    for i in range(64):
        if i < 16:
            f, at = ((c ^ d) & b) ^ d, i
        elif i < 32:
            f, at = ((b ^ c) & d) ^ c, (5 * i + 1) % 16
        elif i < 48:
            f, at = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, at = (~d | b) ^ c, 7 * i % 16
        f += a
        f += words[at]
        f += _SINES[i]
        low = f >> (32 - _SHIFTS[i])
        f <<= _SHIFTS[i]
        f |= low
        f += b
        a, b, c, d = d, f, b, c
    return [(x + s).byteswap() for x, s in zip((a, b, c, d), start)]


class JoinedHashes:
    """MD5 of ``head + text + "|" + salt`` for many texts of one length at once: equals ``key_hash`` of the same text."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.width = texts, len(texts[0])
        span = -(-(self.width + _WORD - 1) // _WORD) * _WORD
        # the texts as columns of words, for each place in a word that they may begin at
        self.laid = [np.ascontiguousarray(np.frombuffer(b"".join((b"\0" * off + t).ljust(span, b"\0") for t in texts), "<u4")
                                          .reshape(len(texts), -1).T) for off in range(_WORD)]

    def md5(self, heads: list[bytes], places: list, counts: np.ndarray, salt: str) -> list[np.ndarray]:
        """Four big-endian 32-bit numbers of each hash: first the texts at ``places[0]`` (a slice or an array of
        ``counts[0]`` numbers) after the first head, and so on."""
        tail = b"|" + salt.encode()
        if max(map(len, heads)) + self.width + len(tail) >= _BLOCK - _LENGTH:  # longer than a block: one by one
            numbers = np.arange(len(self.texts))
            found = b"".join(hashlib.md5(h + self.texts[i] + tail).digest() for h, at in zip(heads, places) for i in numbers[at])
            return list(np.frombuffer(found, ">u4").reshape(-1, 4).T.astype(np.uint32))
        words, at = np.empty((_BLOCK // _WORD, int(counts.sum())), np.uint32), 0
        for head, place, n in zip(heads, places, counts):
            size = len(head) + self.width + len(tail)
            frame = (head + b"\0" * self.width + tail + b"\x80").ljust(_BLOCK - _LENGTH, b"\0") + (8 * size).to_bytes(_LENGTH, "little")
            mine, laid = words[:, at:at + n], self.laid[len(head) % _WORD]
            mine[:] = np.frombuffer(frame, "<u4")[:, None]
            mine[len(head) // _WORD:len(head) // _WORD + len(laid)] |= laid[:, place]
            at += n
        return _one_block_md5(words)


def top_bits(digest: list[np.ndarray], part: int = 0) -> np.ndarray:
    """The digests' first (or second) 13 hex digits as numbers."""
    if part == 0:
        a, b = (x.astype(np.int64) for x in digest[:2])
        return a << 20 | b >> 12
    b, c, d = (x.astype(np.int64) for x in digest[1:])
    return (b & 0xFFF) << 40 | c << 8 | d >> 24


def units(digest: list[np.ndarray], part: int = 0) -> np.ndarray:
    """U(0,1) of the digests, as ``uniform01`` gives it."""
    return (top_bits(digest, part) + 0.5) / _SPAN


def normals(digest: list[np.ndarray]) -> np.ndarray:
    """N(0,1) of the digests, as ``standard_normal`` gives it."""
    return np.sqrt(-2.0 * np.log(units(digest))) * np.cos(2 * math.pi * units(digest, 1))
