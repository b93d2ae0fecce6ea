"""Operator 10: repeated byte strings across documents, by bucket-pointer refinement.

Every byte covered by a ``width``-byte string that also starts in a document with a
smaller id is removed. Sorting every suffix of the corpus would move many times its size, so
the suffix array is refined only where it is undecided:

1. Initial buckets. In each window of ``width`` bytes one q-gram is its anchor (the one
   with the least hash, the first among equals), so equal windows have equal anchors and
   neighbouring windows share one. The q-gram at an anchor is the initial bucket of all windows
   it stands for. A bucket met in one document only is finished.
2. First refinement. The windows of one anchor form a run of text. Runs of the same bucket are told
   apart by the bucket names (hashes) of their first and last window, that is, by
   later and earlier offsets. A run that a smaller document holds too is removed
   whole. Every window of a run reaches half its rest to the left or to the right of the anchor, so a
   kind whose longer anchors to either side no other kind of the bucket has is finished.
3. Second refinement. Where a side is shared, each kind is taken up once, from its smallest
   document, and the windows that lean to that side are refined to single names.

Buckets, kinds, sides and windows are worked out by hash parts, each by a hash of its own, so the kinds and
windows of a common bucket are spread over all parts. Each chunk of documents asks about what
it holds once, however often it occurs there, so a passage that a third of all documents
share costs a row per chunk. Runs and windows are told apart by 64-bit names within their hash part; a
side by 32 bits, where a mistake only means that more windows are refined.

Defined results: a null text counts as empty; rows with a null id lose nothing and
nothing is removed on their account; rows with the same id are not smaller than each
other; texts shorter than ``width`` lose nothing; strings are judged on the input, not on
what is left; an empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chunks, common

WIDTH, QGRAM = 50, 16
#: Windows whose anchors are worked out at once.
STEP = 1 << 17
#: Bytes of text that a hash part answers for at least: each chunk asks nearly every part, so on a small input with many
#: shuffle partitions a part for each of them would mean more questions than documents.
LEAST_PART = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = (1 << 20) - 1


def words_at(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each offset on, as a view."""
    return np.ndarray((max(0, len(raw) - 7),), dtype="<u8", buffer=raw, strides=(1,))


def name_at(x: np.ndarray, at: np.ndarray | slice, width: int) -> np.ndarray:
    """A 64-bit name of the ``width`` bytes from each offset on."""
    def load(o):
        return x[slice(at.start + o, at.stop + o)] if isinstance(at, slice) else x[at + o]
    h = load(0) * _A
    for o in [*range(8, width - 7, 8), *([width - 8] if width % 8 else [])]:
        h = (h ^ (h >> np.uint64(29))) * _B + load(o) * _A
    h ^= h >> np.uint64(32)
    h *= _B
    return h ^ (h >> np.uint64(29))


def mixed(*keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the keys, even over its whole range; different single keys have different hashes."""
    h = keys[0] * _A
    for k in keys[1:]:
        h = (h ^ (h >> np.uint64(29))) * _B + k * _A
    h ^= h >> np.uint64(32)
    h *= _B
    return h ^ (h >> np.uint64(29))


class Runs:
    """The anchors of a chunk's texts and the runs of windows that each stands for."""

    def __init__(self, docs: pa.Table, width: int, qgram: int):
        ids = docs.column("doc_id").combine_chunks()
        self.raw, self.bounds = common.string_bytes(docs.column("text").combine_chunks())
        self.ids, known = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
        self.width, self.qgram, self.half = width, qgram, (width - qgram) // 2
        self.x = words_at(np.concatenate([self.raw, np.zeros(8, np.uint8)]))
        # windows start in [bounds[d], stop[d])
        stop = np.where(known, np.maximum(self.bounds[1:] - width + 1, self.bounds[:-1]), self.bounds[:-1])
        firsts, anchors, owners, names = [], [], [], []
        last = int(stop[stop > self.bounds[:-1]].max(initial=0))
        held = -1
        for s in range(0, last, STEP):
            e = min(last, s + STEP)
            n = e - s + width - qgram
            h = name_at(self.x, slice(s, s + n), qgram)
            least = (h & ~np.uint64(_LOW)) | np.arange(n, dtype=np.uint64)
            reach, span = 1, width - qgram + 1
            while 2 * reach <= span:
                least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
            if reach < span:
                least = np.minimum(least[:len(least) - (span - reach)], least[span - reach:])
            at = (least & np.uint64(_LOW)).astype(np.int64)
            d0, d1 = np.searchsorted(self.bounds, s, "right") - 1, np.searchsorted(self.bounds, e, "left")
            begin, end = np.clip(self.bounds[d0:d1 + 1], s, e)[:-1], np.clip(self.bounds[d0:d1 + 1], s, e)[1:]
            doc = np.repeat(np.arange(d0, d1), end - begin)
            place = np.arange(s, e)
            fresh = np.ones(e - s, bool)
            fresh[1:] = at[1:] != at[:-1]
            fresh[0] = at[0] + s != held
            fresh |= place == self.bounds[doc]
            fresh &= place < stop[doc]
            pick = np.flatnonzero(fresh)
            firsts.append(pick + s)
            anchors.append(at[pick] + s)
            owners.append(doc[pick])
            # an anchor has the least hash of its window, so as they are half of them lie in a fiftieth of the range
            names.append(mixed(h[at[pick]]))
            held = int(at[-1]) + s
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.first, self.doc = join(firsts, np.int64), join(owners, np.int64)
        self.bucket, self.anchor = join(names, np.uint64), join(anchors, np.int64)
        after = np.append(self.first[1:], 0)
        same = np.append(self.doc[1:], -1) == self.doc
        self.stop = np.where(same, after, stop[self.doc] if len(self.doc) else after)
        self.id = self.ids[self.doc] if len(self.doc) else np.zeros(0, np.int64)

    def kinds(self, pick: np.ndarray) -> np.ndarray:
        """A name of each picked run's whole text, from its first and last window."""
        a, b = self.first[pick], self.stop[pick]
        h = name_at(self.x, a, self.width) * _A + name_at(self.x, b - 1, self.width)
        h = (h ^ (h >> np.uint64(31))) * _B + (b - a).astype(np.uint64)
        return h ^ (h >> np.uint64(29))

    def sides(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """32-bit names of the anchor with half a window's rest to its left, and to its right; 0 where
        the run has no window that reaches so far."""
        p, reach = self.anchor[pick], self.qgram + self.half
        out = []
        for begin, has in ((p - self.half, self.first[pick] <= p - self.half), (p, self.stop[pick] - 1 > p - self.half)):
            name = (name_at(self.x, np.where(has, begin, 0), reach) >> np.uint64(32)).astype("<u4") | np.uint32(1)
            out.append(np.where(has, name, np.uint32(0)).astype("<u4"))
        return out[0], out[1]


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts by the keys, start of each distinct group in that order)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def least_ids(ids: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(ids[order], starts) if len(starts) else np.zeros(0, np.int64)


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Hash part of each key, which must be even over 64 bits; grows with the key, so sorted keys are grouped by part."""
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def by_part(chunk: int, key: np.ndarray, parts: int, *columns: np.ndarray, after: int = 0) -> pa.Table:
    """QUESTION rows of sorted keys, for the parts from ``after`` on; the body holds the columns one after the other."""
    part = part_of(key, parts) + after
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(0, int)
    return chunks.question_rows(chunk, [
        (int(part[b]), int(e - b), b"".join(np.ascontiguousarray(c[b:e]).tobytes() for c in columns))
        for b, e in zip(cuts[:-1], cuts[1:])])


def columns_of(rows: pa.Table, *kinds: str) -> tuple[list[int], list[int], list[np.ndarray]]:
    """(chunk and n of each QUESTION row, the columns of all rows end to end)."""
    ns, parts = rows.column("n").to_pylist(), []
    for n, body in zip(ns, rows.column("body").to_pylist()):
        at, row = 0, []
        for k in kinds:
            row.append(np.frombuffer(body, k, n, at))
            at += n * np.dtype(k).itemsize
        parts.append(row)
    return rows.column("chunk").to_pylist(), ns, [np.concatenate(c) for c in zip(*parts)]


def reply_flags(rows: pa.Table, level: int, flags: np.ndarray, asked: list[int], ns: list[int]) -> pa.Table:
    ends = np.cumsum(ns)
    return chunks.answer_rows(rows.column("part")[0].as_py(), level, [
        (c, n, np.packbits(flags[e - n:e]).tobytes()) for c, n, e in zip(asked, ns, ends)])


def flags_told(answers: pa.Table, level: int) -> np.ndarray:
    got = [np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool) for n, body in chunks.told(answers, level)]
    return np.concatenate(got) if got else np.zeros(0, bool)


class Refinement:
    """What a chunk knows after the answers so far; each step repeats the ones before."""

    def __init__(self, docs: pa.Table, width: int, qgram: int):
        self.chunk = docs.column("chunk")[0].as_py()
        self.runs = Runs(docs, width, qgram)

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """(the chunk's buckets in order, whether each is met in two documents here)."""
        r = self.runs
        order, starts = grouped(r.bucket)
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        own = r.id[order]
        return r.bucket[order[starts]], np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)

    def kinds(self, answers: pa.Table):
        """Runs in shared buckets: sets ``pick`` (run numbers), ``kind`` (group number of each) and ``first`` (a
        run of each group), and gives (key, kind name, least id) of each group in the order of keys."""
        r = self.runs
        distinct, _ = self.buckets()
        shared = flags_told(answers, 0)
        self.pick = np.flatnonzero(shared[np.searchsorted(distinct, r.bucket)]) if len(distinct) else np.zeros(0, int)
        bucket, name = r.bucket[self.pick], r.kinds(self.pick)
        key = mixed(bucket, name)
        order, starts = grouped(key, name)
        self.kind = np.empty(len(order), np.int64)
        self.kind[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.kind_id = least_ids(r.id[self.pick], order, starts)
        first = order[starts]
        self.first, self.kind_name = self.pick[first], name[first]
        return key[first], self.kind_name, self.kind_id

    def sides(self):
        """Sides of the kinds: sets ``side`` (group number of each kind's left and right side, -1 for none) and
        gives (key, name of one kind that has it; its last bit tells whether several have) of each group in the
        order of keys. Call ``kinds`` before."""
        names = self.runs.sides(self.first)
        held = [np.flatnonzero(n) for n in names]
        bucket, kind = (np.concatenate([x[h] for h in held]) for x in (self.runs.bucket[self.first], self.kind_name))
        key = mixed(bucket, np.concatenate([n[h].astype(np.uint64) << np.uint64(1) | np.uint64(right)
                                            for right, (n, h) in enumerate(zip(names, held))]))
        order, starts = grouped(key)
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.side = [np.full(len(self.first), -1), np.full(len(self.first), -1)]
        for side, h, at in zip(self.side, held, np.split(group, [len(held[0])])):
            side[h] = at
        if not len(starts):
            return key, kind
        least, most = np.minimum.reduceat(kind[order], starts), np.maximum.reduceat(kind[order], starts)
        return key[order[starts]], least & ~np.uint64(1) | (least != most).astype(np.uint64)

    def windows(self, answers: pa.Table):
        """Windows of the kinds that are still undecided, from the kind's smallest document."""
        r = self.runs
        self.kinds(answers)
        self.sides()
        self.later = flags_told(answers, 1)
        left, right = (np.append(flags_told(answers, 2), False)[side] for side in self.side)
        open_kind = (left | right) & ~self.later
        mine = np.flatnonzero(open_kind[self.kind] & (r.id[self.pick] == self.kind_id[self.kind])) if len(self.kind) else np.zeros(0, int)
        run, kind = self.pick[mine], self.kind[mine]
        # windows that lean left need a shared left side, the others a shared right side
        middle = np.clip(r.anchor[run] - r.half + 1, r.first[run], r.stop[run])
        begin, end = np.where(left[kind], r.first[run], middle), np.where(right[kind], r.stop[run], middle)
        sizes = end - begin
        self.at = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        self.at_id = np.repeat(r.id[run], sizes)
        bucket, name = np.repeat(r.bucket[run], sizes), name_at(r.x, self.at, r.width)
        key = mixed(bucket, name)
        order, starts = grouped(key, name)
        self.window = np.empty(len(order), np.int64)
        self.window[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.window_id = least_ids(self.at_id, order, starts)
        first = order[starts]
        return key[first], name[first], self.window_id

    def covered(self, answers: pa.Table) -> np.ndarray:
        """Whether each byte of the chunk goes."""
        r = self.runs
        self.windows(answers)
        depth = np.zeros(len(r.raw) + 1, np.int32)
        if len(self.kind):
            whole = self.pick[self.later[self.kind] | (r.id[self.pick] > self.kind_id[self.kind])]
            np.add.at(depth, r.first[whole], 1)
            np.add.at(depth, r.stop[whole] + r.width - 1, -1)
        if len(self.window):
            single = self.at[flags_told(answers, 3)[self.window] | (self.at_id > self.window_id[self.window])]
            np.add.at(depth, single, 1)
            np.add.at(depth, single + r.width, -1)
        return np.cumsum(depth[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = WIDTH, qgram: int = QGRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): a row for each row of ``docs``."""
    if not 8 <= qgram <= width:
        raise ValueError("a q-gram has 8 to width bytes")
    table, parts = chunks.chunk_table(docs, id_col, text_col, least_part=LEAST_PART)

    def ask_buckets(docs, _):
        got = Refinement(docs, width, qgram)
        bucket, twice = got.buckets()
        return by_part(got.chunk, bucket, parts, (bucket & np.uint64(0xFFFFFFFF)).astype("<u4"), twice.astype("u1"))

    def reply_buckets(rows):
        asked, ns, (key, twice) = columns_of(rows, "<u4", "u1")
        order, starts = grouped(key)
        sizes = np.diff(np.append(starts, len(order)))
        flags = np.empty(len(key), bool)
        flags[order] = np.repeat((sizes > 1) | (np.maximum.reduceat(twice[order], starts) > 0), sizes)
        return reply_flags(rows, 0, flags, asked, ns)

    def ask_kinds(docs, answers):
        if not docs.num_rows:
            return chunks.question_rows(0, [])
        got = Refinement(docs, width, qgram)
        key, *columns = got.kinds(answers)
        side, kind = got.sides()
        return pa.concat_tables([by_part(got.chunk, key, parts, *columns), by_part(
            got.chunk, side, parts, (side & np.uint64(0xFFFFFFFF)).astype("<u4"), kind, after=parts)])

    def later_flags(rows, level):
        asked, ns, (name, least) = columns_of(rows, "<u8", "<i8")
        order, starts = grouped(name)
        later = np.empty(len(name), bool)
        later[order] = least[order] > np.repeat(least_ids(least, order, starts), np.diff(np.append(starts, len(order))))
        return reply_flags(rows, level, later, asked, ns)

    def reply_kinds(rows):
        if rows.column("part")[0].as_py() < parts:
            return later_flags(rows, 1)
        asked, ns, (side, kind) = columns_of(rows, "<u4", "<u8")
        order, starts = grouped(side)
        several, kind = kind[order] & np.uint64(1), kind[order] >> np.uint64(1)
        # shared if another kind of the same bucket has the same side
        shared = (np.minimum.reduceat(kind, starts) != np.maximum.reduceat(kind, starts)) | (np.maximum.reduceat(several, starts) > 0)
        flags = np.empty(len(side), bool)
        flags[order] = np.repeat(shared, np.diff(np.append(starts, len(order))))
        return reply_flags(rows, 2, flags, asked, ns)

    def ask_windows(docs, answers):
        if not docs.num_rows:
            return chunks.question_rows(0, [])
        got = Refinement(docs, width, qgram)
        key, *columns = got.windows(answers)
        return by_part(got.chunk, key, parts, *columns)

    def reply_windows(rows):
        return later_flags(rows, 3)

    def cut(docs, answers):
        if not docs.num_rows:
            return _kept([], [], [], [], [])
        got = Refinement(docs, width, qgram)
        gone = got.covered(answers)
        raw, bounds = got.runs.raw, got.runs.bounds
        counts, spans, kept = [], [], []
        for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            mask = gone[b:e]
            counts.append(int(mask.sum()))
            spans.append(int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(e > b and mask[0]))
            kept.append(raw[b:e][~mask].tobytes() if counts[-1] else raw[b:e].tobytes())
        return _kept(docs.column("doc_id"), np.diff(bounds), counts, spans, kept)

    answers = chunks.ask(table, None, ask_buckets, reply_buckets)
    answers = answers.union(chunks.ask(table, answers, ask_kinds, reply_kinds))
    answers = answers.union(chunks.ask(table, answers, ask_windows, reply_windows))
    return chunks.each_chunk(table, answers, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _kept(doc_id, n_bytes, n_removed, n_spans, kept) -> pa.Table:
    ids = doc_id if isinstance(doc_id, pa.ChunkedArray) else pa.array(doc_id, pa.int64())
    return pa.table({"doc_id": ids, "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "n_spans": pa.array(n_spans, pa.int64()), "kept": pa.array(kept, pa.binary())})


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without 50-byte strings of smaller documents, as digests."""
    got = remove_repeats(common.table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
