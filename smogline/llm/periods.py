"""Operator 11: runs of words that repeat with a period, by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at
least max(24, 3 q) words, that no neighbouring word extends. The words of a slice of
documents are numbered and laid end to end, a number of its own after each document, so no run goes over.
Periods below 32 are found by direct scans: one comparison of all words with those q further on.
Longer periods are found scale by scale. At scale P (32, 64, ...), for periods from P to 2 P - 1, each window
of P consecutive P-grams marks its least hash. A run holds two windows a period apart at least, so two marked
P-grams of equal hash lie exactly a period apart; each such pair is a seed, compared word by word to both sides.
P-grams inside a run of a period up to P / 3 that is known by then are left out but for the run's first, so
that equal marks stay at least P / 3 apart and pairs stay linear in the text; by the theorem of Fine and
Wilf, two runs of different periods share too few words for that to hide a longer period.

Defined results: a null text has no words; a null id leaves the words as they are (no test repetition is
written into them); rows repeated with the same id are rows of their own, each with its row; an empty table gives
none; further columns are ignored. A document is worked on whole, in memory a small multiple of its own size.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

#: A run has so many words at least, and so many periods.
LEAST, TURNS = 24, 3
#: Periods below this are found by direct scans; the first scale. A power of two, at least LEAST.
SHORT = 32
NONE = np.uint64(2**64 - 1)
#: An odd number and its inverse modulo 2^64, for sums of words times powers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")


def least_length(period: int) -> int:
    return max(LEAST, TURNS * period)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    x = x.astype(np.uint64)
    for shift, times in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def scan(ids: np.ndarray, q: int) -> list[tuple[int, int]]:
    """(start, end) of all stretches of period q that are long enough."""
    breaks = np.concatenate([[-1], np.flatnonzero(ids[q:] != ids[:-q]), [len(ids) - q]])
    long = np.flatnonzero(np.diff(breaks) > least_length(q) - q)
    return [(int(breaks[i]) + 1, int(breaks[i + 1]) + q) for i in long]


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams."""
    n = len(ids)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(ids) * powers(BASE, n), dtype=np.uint64)])
    return mixed((sums[k:] - sums[:-k]) * powers(INVERSE, n)[:n - k + 1]) >> np.uint64(1)


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Positions, ascending, of the first least hash of each window of w (a power of two)."""
    at, step = np.arange(len(h)), 1
    least = h
    while step < w:
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.where(right, least[step:], least[:-step])
        step *= 2
    marked = np.zeros(len(h), bool)
    marked[at[least < NONE]] = True
    return np.flatnonzero(marked)


def seeds(ids: np.ndarray, scale: int, known: list[tuple[int, int, int]]) -> np.ndarray:
    """(distance, position) of pairs of equal marked grams from ``scale`` to twice that apart, sorted."""
    if len(ids) < TURNS * scale:
        return np.zeros((0, 2), np.int64)
    h = gram_hashes(ids, scale)
    inner = np.zeros(len(h) + 1, np.int64)
    for start, end, q in known:
        if TURNS * q <= scale and end - start > scale:
            inner[start + 1] += 1
            inner[end - scale + 1] -= 1
    h[np.cumsum(inner[:-1]) > 0] = NONE
    marked = window_minima(h, scale)
    order = np.lexsort((marked, h[marked]))
    at, value = marked[order], h[marked[order]]
    out, step, alive = [], 1, np.arange(len(at))
    while True:
        alive = alive[alive + step < len(at)]
        far = at[alive + step] - at[alive]
        near = (value[alive + step] == value[alive]) & (far < 2 * scale)
        alive, far = alive[near], far[near]
        if not len(alive):
            break
        fits = far >= scale
        out.append(np.stack([far[fits], at[alive[fits]]], axis=1))
        step += 1
    got = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return got[np.lexsort((got[:, 1], got[:, 0]))]


def reach(ids: np.ndarray, at: int, lag: int, to: int) -> int:
    """How many words from ``at`` on, in direction ``to``, equal those ``lag`` further on."""
    n, size = 0, 64
    while True:
        if to > 0:
            a = ids[at + n:at + n + size]
            b = ids[at + n + lag:at + n + lag + size]
            a = a[:len(b)]
        else:
            low = max(0, at - n - size + 1)
            a, b = ids[low:at - n + 1][::-1], ids[low + lag:at - n + 1 + lag][::-1]
        differs = np.flatnonzero(a != b)
        if len(differs):
            return n + int(differs[0])
        n += len(a)
        if len(a) < size:
            return n
        size = min(2 * size, 1 << 16)


def runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, sorted by start and period. ``ids``: the words of documents with these
    first positions and numbers of words, a number of its own after each."""
    longest = int(sizes.max(initial=0))
    found: dict[tuple[int, int], int] = {}
    for q in range(1, min(SHORT, longest // TURNS + 1) if longest >= LEAST else 1):
        for place in scan(ids, q):
            found.setdefault(place, q)  # an equal stretch with a smaller period is the same run
    scale = SHORT
    while TURNS * scale <= longest:
        # the documents that are long enough, end to end
        part = np.flatnonzero(sizes >= TURNS * scale)
        ends = np.cumsum(sizes[part] + 1)
        moved = starts[part] - (ends - sizes[part] - 1)
        where = np.arange(ends[-1]) + np.repeat(moved, sizes[part] + 1)
        here = []
        for (start, end), q in found.items():
            i = int(np.searchsorted(starts[part], start, side="right")) - 1
            if i >= 0 and end <= starts[part][i] + sizes[part][i]:
                here.append((start - int(moved[i]), end - int(moved[i]), q))
        done, lag = 0, 0
        for q, at in seeds(ids[where], scale, here).tolist():
            at = int(where[at])
            if q != lag:
                done, lag = 0, q
            if at < done or at + q >= len(ids) or ids[at] != ids[at + q]:
                continue
            done = at + reach(ids, at, q, 1)
            start = at - reach(ids, at, q, -1) + 1
            if done + q - start >= least_length(q):
                known = found.get((start, done + q), q)
                found[start, done + q] = min(known, q)
        scale *= 2
    return sorted((start, end, q) for (start, end), q in found.items())


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the test repetition that a tenth of the ids, by checksum, get."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[:n - a]


def described(batch: pa.RecordBatch) -> pa.RecordBatch:
    """SCHEMA rows of (doc_id, text) rows."""
    ids = batch.column(0).to_pylist()
    texts = batch.column(1).cast(pa.binary()).to_pylist()
    # bytes.split cuts at space and at 09 to 0D, and at nothing else
    words = [repeated((t or b"").split(), i) for i, t in zip(ids, texts)]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.empty(int((sizes + 1).sum()), np.int64)
    inside = np.ones(len(flat), bool)
    inside[starts + sizes] = False
    flat[inside] = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices.to_numpy()
    flat[~inside] = -1 - np.arange(len(sizes))
    of_doc: dict[int, list[tuple[int, int, int]]] = {}
    for start, end, q in runs(flat, starts, sizes):
        d = int(np.searchsorted(starts, start, side="right")) - 1
        of_doc.setdefault(d, []).append((start - int(starts[d]), end - start, q))
    out = []
    for d, (doc_id, w) in enumerate(zip(ids, words)):
        mine = of_doc.get(d, [])
        best, kept = (None, None, None, None), w
        if mine:
            start, length, q = min(mine, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            best = start, length, q, 1000 * length // q
            cover = np.zeros(len(w) + 1, np.int64)
            for start, length, q in mine:
                cover[start + q] += 1
                cover[start + length] -= 1
            kept = [w[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) <= 0)]
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in mine)
        out.append((doc_id, len(mine), *best, hashlib.sha256(lines.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(kept)).hexdigest(), len(w), len(w) - len(kept)))
    cols = list(zip(*out))
    kinds = [pa.string() if "sha256" in part else pa.int64() for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, kinds)],
                                      names=[part.split()[0] for part in SCHEMA.split(", ")])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row of SCHEMA for each document: its number of runs, the run with the most periods, digests of all
    runs and of the words left when each run is cut to its first period."""
    return common.map_text(common.plain_rows(docs, id_col, text_col), described, SCHEMA)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document."""
    return periodic_runs(common.table(spark, sf_dir, "documents"))
