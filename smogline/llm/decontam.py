"""Operator 2: benchmark decontamination by spaced-seed hashing.

A text becomes a sequence of tokens: lower case, ASCII punctuation read as space,
split at white space. A mask such as ``111011`` slides over the tokens and hashes
those at its ones; the tokens at its zeros may differ. Seeds of documents meet seeds of
benchmark items, each hit names a diagonal (the item laid over the document without
gaps), and the diagonal is verified: the item leaks if, in some window of
``window`` tokens, at least ``similarity`` of the tokens are equal. Where item or document end before a
window is full, as on a passage cut at a document's edge, the window is what of the item lies over the
document, ``min_tokens`` at least. The default masks were found by trying every pattern of up to a fifth of
substituted tokens in windows of 8 to 13: each leaves one mask whole, so
the seeds lose no overlap that the verification accepts. An item of fewer than ``min_tokens`` tokens is sought
by its whole sequence, without substitutions; one of one or two tokens, which stand in any text, leaks only into a
document that holds nothing else.

The benchmark is a stated query set. It is taken in blocks of at most
``BLOCK_BYTES`` of text (or one item, if longer), and documents are read once for each block. Of several
blocks each one's result is written before the next block is collected, and its seeds are then taken back, so
driver and tasks hold one block at a time. Nothing is shuffled.

Defined results: null and empty texts hold no overlap, and items without tokens match nothing; items with a null id are reported
with a null id; repeated documents repeat their rows, repeated items with the same
id count once; an empty table on either side gives no rows. A document row and an
item make at most one row: the window with most equal tokens, the first in the
document among equals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from smogline.session import pin_table

from . import common

#: Ones are compared, zeros are ignored.
MASKS = ("111011", "11010011", "11111")
WINDOW, MIN_TOKENS, SIMILARITY = 13, 8, 0.8
#: Items of fewer tokens leak only into a document that holds nothing else.
ANYWHERE = 3
BLOCK_BYTES = 8 << 20
FOUND = "doc_id long, item_id long, equal_tokens int, window_tokens int, doc_start int, item_start int"

_SPACES = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SPACES).split()


class Seeds:
    """The seeds of one block of items, and the search of documents for them."""

    def __init__(self, items: list[tuple[int | None, str | None]], masks=MASKS, window=WINDOW,
                 min_tokens=MIN_TOKENS, similarity=SIMILARITY):
        self.window, self.min_tokens, self.similarity = window, min_tokens, similarity
        # (tokens that are compared, the length of items sought whole or 0)
        self.masks = [(np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == ord("1")), 0) for m in masks]
        self.vocab: dict[bytes, int] = {}
        self.items = []
        for item_id, text in items:
            words = tokens(text)
            if words:
                self.items.append((item_id, np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words])))
        short = {len(ids) for _, ids in self.items if len(ids) < min_tokens}
        self.masks += [(np.arange(n), n) for n in sorted(short)]
        self.least = min([4, *short])
        self.index = []
        for ones, whole in self.masks:
            seeds, item, at = [], [], []
            for i, (_, ids) in enumerate(self.items):
                if (len(ids) if len(ids) < min_tokens else 0) != whole:
                    continue
                h = self.hashes(ids, ones)
                seeds.append(h)
                item.append(np.full(len(h), i))
                at.append(np.arange(len(h)))
            seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
            order = np.argsort(seeds, kind="stable")
            item = np.concatenate(item)[order] if item else np.zeros(0, int)
            at = np.concatenate(at)[order] if at else np.zeros(0, int)
            self.index.append((seeds[order], item, at))

    def hashes(self, ids: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """A hash at each position where the mask fits; 0 where it would compare an unknown token."""
        n = len(ids) - int(ones[-1])
        if n <= 0:
            return np.zeros(0, np.uint64)
        ids = ids.astype(np.uint64)
        h, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in ones:
            part = ids[k:k + n]
            known &= part != 0
            h = (h ^ part) * _MIX
            h ^= h >> np.uint64(29)
        return np.where(known, h | np.uint64(1), 0)

    def search(self, text: str | None) -> Iterator[tuple]:
        """(item index, equal tokens, window, start in the document, start in the item)."""
        get = self.vocab.get
        ids = np.array([get(w, 0) for w in tokens(text)], dtype=np.int64)
        found = set()
        if np.count_nonzero(ids) < self.least:
            return
        for (ones, _), (seeds, item, at) in zip(self.masks, self.index):
            h = self.hashes(ids, ones)
            here = np.flatnonzero(h)
            if not len(here) or not len(seeds):
                continue
            low = np.searchsorted(seeds, h[here])
            same = (low < len(seeds)) & (seeds[np.minimum(low, len(seeds) - 1)] == h[here])
            here, low = here[same], low[same]
            high = np.searchsorted(seeds, h[here], side="right")
            for p, lo, hi in zip(here.tolist(), low.tolist(), high.tolist()):
                found.update(zip(item[lo:hi].tolist(), (p - at[lo:hi]).tolist()))
        best: dict[int, tuple] = {}
        for i, shift in found:
            got = self.verify(ids, i, shift)
            if got and (i not in best or got < best[i]):
                best[i] = got
        for i, (missing, window, start, item_start) in best.items():
            yield i, -missing, window, start, item_start

    def verify(self, ids: np.ndarray, i: int, shift: int):
        """The best window on a diagonal as (- equal tokens, window, starts), if it is similar enough."""
        item = self.items[i][1]
        first, last = max(0, -shift), min(len(item), len(ids) - shift)
        if len(item) < self.min_tokens:
            n = len(item)
            if last - first < n or (n < ANYWHERE and len(ids) != n) or not np.array_equal(ids[shift:shift + n], item):
                return None
            return -n, n, shift, 0
        window = min(self.window, last - first)
        if window < self.min_tokens:
            return None
        equal = np.concatenate([[0], np.cumsum(ids[first + shift:last + shift] == item[first:last])])
        sums = equal[window:] - equal[:-window]
        k = int(np.argmax(sums))
        if sums[k] < self.similarity * window:
            return None
        return -int(sums[k]), window, first + k + shift, first + k


def by_block(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, step, settings: dict) -> Iterator[DataFrame]:
    """``step(broadcast seeds)`` for each bounded block of the benchmark. Of several, each is written, and its
    seeds are taken back, before the next is collected."""
    sc = docs.sparkSession.sparkContext
    rows = common.plain_rows(benchmark, id_col, text_col).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    for b in range(n):
        part = rows.filter(common.hash_part(F.xxhash64("doc_id", "text"), n, "items") == b) if n > 1 else rows
        sent = sc.broadcast(Seeds(sorted(map(tuple, part.collect()), key=str), **settings))
        if n == 1:
            yield step(sent)
            return
        yield pin_table(step(sent), "overlaps")
        sent.destroy()


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text", **settings) -> DataFrame:
    """A row for each document row and benchmark item that overlap."""
    rows = common.plain_rows(docs, id_col, text_col)

    def step(sent) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            seeds = sent.value
            got = [(d, seeds.items[i][0], *rest) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                   for i, *rest in sorted(seeds.search(t))]
            cols = list(zip(*got)) if got else [[]] * 6
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                              names=[c.split()[0] for c in FOUND.split(", ")])

        return common.map_text(rows, run, FOUND)

    return reduce(DataFrame.union, by_block(docs, benchmark, item_id_col, item_text_col, step, settings))


def without_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                     item_id_col: str = "item_id", item_text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns."""
    at, names = docs.columns.index(text_col), docs.columns
    # by number on the way: Python stages take no names with dots
    left = [docs.toDF(*(f"c{k}" for k in range(len(names))))]
    schema = left[0].schema

    def step(sent) -> DataFrame:
        def run(batches):
            for batch in batches:
                keep = [next(sent.value.search(t), None) is None for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return left[-1].mapInArrow(run, schema)

    # each block sees what the blocks before it left
    for kept in by_block(docs, benchmark, item_id_col, item_text_col, step, settings):
        left.append(kept)
    return left[-1].toDF(*names)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of all ``documents`` with all ``benchmark`` items."""
    return overlaps(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
