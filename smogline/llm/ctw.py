"""Operator 7: language-model scores by context-tree weighting.

Every byte is eight binary decisions; each decision has a tree over the bytes before it,
up to ``depth`` of them. A tree node estimates its decision by Krichevsky-Trofimov from the
counts of the training documents, and the weighted probability of a node is half its
own estimate of all it saw and half the product of its children's. Reading the weights
from the root down mixes the estimates of all depths into one probability for each byte after
each context; its logarithm is the code length. A context that training never saw is no
part of the tree, so the mix ends at the deepest one seen. Texts begin after zero bytes
and end with a byte that UTF-8 never has.

Counts are of distinct contexts by chunk of documents, summed by hash part of the two
latest bytes, so a part holds whole subtrees. Only the nodes above (at most 256 * 255
decisions after one byte) are summed for all and sent to the tasks. Each chunk gets back the code length
of just the strings it has, in the order in which it asked, as 32-bit numbers (a score is right to about 1e-7 of
itself). Word counts for the base score travel the same way. The tree reads the bytes as they are; only the words are lower-cased.

Defined results: a null text counts as empty and has one token, its end; a row with a
null id is scored but not learned from, and its held_out is null; repeated rows count
and score each; without training documents every decision has probability one half; an empty table
gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chunks, common

#: As many bytes of context as fit a packed number beside the byte itself.
DEPTH = 6
END = b"\n"  # no word holds white space
#: Text of a chunk (the larger, the fewer strings are asked for twice), text handled at once, strings of one step of trees.
CHUNK_BYTES, BLOCK_BYTES, BLOCK_GRAMS = 16 << 20, 2 << 20, 1 << 16
ASKED = "part int, chunk int, n_words int, n_grams int, body binary"
TOLD = "chunk int, part int, n_words int, n_grams int, body binary"
SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, n_bytes long, bits_per_byte double")
_A = np.uint64(0x9E3779B97F4A7C15)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series above 8, and the recurrence below."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift = np.where(low, shift - np.log(np.where(low, x, 1.0)), shift)
        x = np.where(low, x + 1, x)
    r = 1 / (x * x)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1) - math.log(math.pi)


def weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log of the weighted probability, share of the node's own estimate in it)."""
    both = np.logaddexp(own, below) - math.log(2)
    return both, np.exp(own - np.logaddexp(own, below))


# ------------------------------------------------------------------ numbers on the way

def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending numbers as steps of one to eight bytes, counts of one byte or, from 255 on, of nine."""
    step = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    size = np.ones(len(step), np.uint8)
    for k in range(1, 8):
        size += step >= np.uint64(1 << 8 * k)
    body = step.view(np.uint8).reshape(-1, 8)[np.arange(8) < size[:, None]]
    return b"".join(x.tobytes() for x in (size, np.minimum(counts, np.uint64(255)).astype(np.uint8),
                                          counts[counts >= 255].astype("<u8"), body))


def unpacked(body: memoryview, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, counts) of ``packed``."""
    size, counts = np.frombuffer(body, np.uint8, n), np.frombuffer(body, np.uint8, n, n).astype(np.uint64)
    large = np.flatnonzero(counts == 255)
    counts[large] = np.frombuffer(body, "<u8", len(large), 2 * n)
    step = np.zeros((n, 8), np.uint8)
    step[np.arange(8) < size[:, None]] = np.frombuffer(body, np.uint8, -1, 2 * n + 8 * len(large))
    return np.cumsum(step.reshape(-1).view("<u8"), dtype=np.uint64), counts


def squeezed(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unsqueezed(body: bytes) -> memoryview:
    return memoryview(pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True))


def summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """(distinct keys in order, the sum of each value over equal keys)."""
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    return [key[starts], *(np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values)]


# ------------------------------------------------------------------ what a chunk holds

class Texts:
    """The words and the byte strings of a chunk's documents."""

    def __init__(self, docs: pa.Table, depth: int):
        self.chunk = docs.column("chunk")[0].as_py()
        self.ids = docs.column("doc_id").to_pylist()
        rest = [None if i is None else zlib.crc32(str(i).encode()) % 10 for i in self.ids]
        self.held = [None if r is None else r == 0 for r in rest]
        self.learn = np.array([h is False for h in self.held])
        self.raw = [t.encode() for t in docs.column("text").to_pylist()]
        self.depth = depth

    def words(self) -> tuple[list[np.ndarray], np.ndarray]:
        """(for each document the numbers of its words, the words' hashes in order); equal hashes are one word."""
        number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        get, lists = number.__getitem__, []
        for r in self.raw:
            words = [*r.lower().split(), END]
            lists.append(np.fromiter(map(get, words), np.int64, len(words)))
        distinct, place = np.unique(np.array([xxhash.xxh64_intdigest(w) for w in number], dtype=np.uint64), return_inverse=True)
        return [place[words] for words in lists], distinct

    def blocks(self):
        """(documents, keys, bounds) for about BLOCK_BYTES of text at a time, long texts in pieces: a number for
        each byte and end (its context, latest byte first, and itself) and where each document's begin."""
        owner, parts, held = [], [], 0
        for d, r in enumerate(self.raw):
            whole = bytes(self.depth) + r + b"\xff"
            for at in range(0, len(r) + 1, BLOCK_BYTES):
                owner.append(d)
                parts.append(whole[at:at + BLOCK_BYTES + self.depth])
                held += len(parts[-1])
                if held >= BLOCK_BYTES:
                    yield np.array(owner), *self.keys(parts)
                    owner, parts, held = [], [], 0
        if parts:
            yield np.array(owner), *self.keys(parts)

    def keys(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        depth, flat = self.depth, np.frombuffer(b"".join(parts), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(p) - depth for p in parts])])
        key = np.zeros(len(flat) - depth, np.uint64)
        for k in range(1, depth + 1):
            key = key << np.uint64(8) | flat[depth - k:len(flat) - k]
        key = key << np.uint64(8) | flat[depth:]
        # a piece's keys start where its padding did
        here = np.ones(len(key), bool)
        for d in range(depth):
            here[(bounds[1:-1] + depth * np.arange(1, len(parts))) - 1 - d] = False
        return key[here], bounds

    def grams(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash part, byte string, training count) of each distinct byte string, by part and string."""
        keys, times = [], []
        for owner, key, bounds in self.blocks():
            # the lowest bit tells training documents, so that one sort counts both
            mark = np.sort(key << np.uint64(1) | np.repeat(self.learn[owner].astype(np.uint64), np.diff(bounds)))
            starts = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
            keys.append(mark[starts] >> np.uint64(1))
            times.append(np.diff(np.append(starts, len(mark))).astype(np.uint64) * (mark[starts] & np.uint64(1)))
        grams, seen = summed(np.concatenate(keys), np.concatenate(times))
        # strings of one pair of latest bytes stand together and stay so
        pair = grams >> np.uint64(8 * (self.depth - 1))
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        part, sizes = gram_part(grams[starts], self.depth, parts), np.diff(np.append(starts, len(grams)))
        runs = np.argsort(part, kind="stable")
        sizes = sizes[runs]
        order = np.repeat(starts[runs] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(grams))
        return np.repeat(part[runs], sizes), grams[order], seen[order]


def gram_part(keys: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """Hash part of the two latest context bytes."""
    top = (keys >> np.uint64(8 * (depth - 1))) * _A
    return ((top >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def ask(docs: pa.Table, depth: int, parts: int) -> pa.Table:
    """ASKED rows: words (hash, training count) and byte strings (number, training count) of a chunk."""
    texts = Texts(docs, depth)
    lists, hashes = texts.words()
    count = np.zeros(len(hashes), np.uint64)
    for k in np.flatnonzero(texts.learn):
        np.add.at(count, lists[k], np.uint64(1))
    word_part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    at_part, grams, seen = texts.grams(parts)
    rows = []
    for p in np.union1d(word_part, at_part).tolist():
        w = slice(*np.searchsorted(word_part, [p, p + 1]))
        g = slice(*np.searchsorted(at_part, [p, p + 1]))
        body = hashes[w].tobytes() + count[w].astype("<u8").tobytes() + packed(grams[g], seen[g])
        rows.append((p, texts.chunk, w.stop - w.start, g.stop - g.start, squeezed(body)))
    cols = list(zip(*rows))
    return pa.table({n: pa.array(c, pa.binary() if n == "body" else pa.int32())
                     for n, c in zip(("part", "chunk", "n_words", "n_grams", "body"), cols)})


# ------------------------------------------------------------------ what a part knows

class Subtrees:
    """The trees below some pairs of latest context bytes: their byte strings in order, and training counts."""

    def __init__(self, grams: np.ndarray, seen: np.ndarray, depth: int):
        self.depth = depth
        byte, bits = (grams & np.uint64(255)).astype(np.uint8), np.arange(8, dtype=np.uint8)
        self.bit = (byte[:, None] >> (7 - bits) & 1).astype(bool).ravel()
        node = ((1 << bits) | byte.astype(np.uint16)[:, None] >> (8 - bits)).astype(np.uint64)
        code, self.at = np.unique((grams[:, None] & ~np.uint64(255) | node).ravel(), return_inverse=True)
        self.at = self.at.astype(np.int32)
        n = np.repeat(seen.astype(float), 8)
        # by depth: the counts of each node, its number among the nodes above, and its own share
        self.n1, self.n0, self.up, self.own = {}, {}, {}, {}
        self.n1[depth] = np.bincount(self.at, n * self.bit, len(code))
        self.n0[depth] = np.bincount(self.at, n, len(code)) - self.n1[depth]
        self.total = log_kt(self.n0[depth], self.n1[depth])
        for d in range(depth - 1, 1, -1):
            code, self.up[d + 1] = np.unique(code >> np.uint64(16) << np.uint64(8) | code & np.uint64(255), return_inverse=True)
            self.n0[d], self.n1[d], below = (np.bincount(self.up[d + 1], v, len(code)) for v in (self.n0[d + 1], self.n1[d + 1], self.total))
            self.total, self.own[d] = weigh(log_kt(self.n0[d], self.n1[d]), below)
        #: decisions after one byte of context
        self.one = (code >> np.uint64(16) << np.uint64(8) | code & np.uint64(255)).astype(np.int64)

    def code_lengths(self, upper: dict) -> np.ndarray:
        """log10 of the probability of each byte string's last byte."""
        chain = p = known = None
        for d in range(self.depth, -1, -1):
            if d >= 2:
                n0, n1, own = self.n0[d], self.n1[d], self.own.get(d, 1.0)
                if chain is not None:
                    n0, n1, own = n0[chain], n1[chain], own[chain]
            else:
                where = self.one[chain] if chain is not None else self.one
                where = where if d else where & 255
                n0, n1, own = (upper[f"{k}{d}"][where] for k in ("n0_", "n1_", "own_"))
            kt = (n1 + 0.5) / (n0 + n1 + 1)
            p = kt if p is None else np.where(known, own * kt + (1 - own) * p, kt)
            known = n0 + n1 > 0
            if d > 2:
                chain = self.up[d] if chain is None else self.up[d][chain]
        return np.log10(np.where(self.bit, p[self.at], 1 - p[self.at]).reshape(-1, 8)).sum(axis=1)


class Part:
    """The summed counts of a hash part; its trees are built for some pairs of latest bytes at a time."""

    def __init__(self, rows: pa.Table, depth: int):
        self.depth, self.rows = depth, rows.select(["part", "chunk", "n_words", "n_grams"]).to_pylist()
        self.words, self.grams, counts, seen = [], [], [], []
        for row, body in zip(self.rows, rows.column("body")):
            n, body = row["n_words"], unsqueezed(body.as_py())
            self.words.append(np.frombuffer(body, np.uint64, n))
            counts.append(np.frombuffer(body, np.uint64, n, 8 * n))
            for out, x in zip((self.grams, seen), unpacked(body[16 * n:], row["n_grams"])):
                out.append(x)
        self.word, self.count = summed(np.concatenate(self.words), np.concatenate(counts))
        self.gram, self.seen = summed(np.concatenate(self.grams), np.concatenate(seen))

    def subtrees(self):
        """(slice of the byte strings, their trees), whole pairs of latest bytes, as few as hold BLOCK_GRAMS."""
        pair = self.gram >> np.uint64(8 * (self.depth - 1))
        ends = np.append(np.flatnonzero(pair[1:] != pair[:-1]) + 1, len(pair))
        at = 0
        while at < len(pair):
            to = int(ends[min(np.searchsorted(ends, at + BLOCK_GRAMS), len(ends) - 1)])
            yield slice(at, to), Subtrees(self.gram[at:to], self.seen[at:to], self.depth)
            at = to

    def top(self) -> pa.Table:
        """(code, below, n0, n1) by decision after one byte of context; code -1 has the words' totals."""
        sums = np.zeros((3, 1 << 16))
        for _, tree in self.subtrees():
            for k, v in enumerate((tree.total, tree.n0[2], tree.n1[2])):
                sums[k] += np.bincount(tree.one, v, 1 << 16)
        code = np.flatnonzero(sums[1] + sums[2])
        below, n0, n1 = sums[:, code]
        return pa.table({"code": pa.array([-1, *code.tolist()], pa.int32()), "below": pa.array([0.0, *below.tolist()]),
                         "n0": pa.array([int(self.count.sum()), *n0.astype(int).tolist()], pa.int64()),
                         "n1": pa.array([int(np.count_nonzero(self.count)), *n1.astype(int).tolist()], pa.int64())})

    def tell(self, upper: dict) -> pa.Table:
        """TOLD rows: each chunk's words' counts, and the code lengths of its byte strings, in the order asked."""
        lengths = np.empty(len(self.gram), np.float32)
        for here, tree in self.subtrees():
            lengths[here] = tree.code_lengths(upper)
        bodies = [squeezed(self.count[np.searchsorted(self.word, words)].tobytes() + lengths[np.searchsorted(self.gram, grams)].tobytes())
                  for words, grams in zip(self.words, self.grams)]
        cols = {n: pa.array([r[n] for r in self.rows], pa.int32()) for n in ("chunk", "part", "n_words", "n_grams")}
        return pa.table(cols | {"body": pa.array(bodies, pa.binary())})


def upper_tree(rows) -> tuple[dict, int, int]:
    """(arrays of the nodes with one and no byte of context, training tokens, distinct training words)."""
    below, n0, n1 = (np.zeros(1 << 16) for _ in range(3))
    tokens = distinct = 0
    for r in rows:
        if r["code"] < 0:
            tokens, distinct = r["n0"], r["n1"]
        else:
            below[r["code"]], n0[r["code"]], n1[r["code"]] = r["below"], r["n0"], r["n1"]
    total, own = weigh(log_kt(n0, n1), below)
    total = np.where(n0 + n1 > 0, total, 0.0)
    out = {"n0_1": n0, "n1_1": n1, "own_1": own}
    zero, one, under = (v.reshape(256, 256).sum(axis=0) for v in (n0, n1, total))
    return out | {"n0_0": zero, "n1_0": one, "own_0": weigh(log_kt(zero, one), under)[1]}, int(tokens), int(distinct)


# ------------------------------------------------------------------ scores

class Lookup:
    """Values by number, in a table with open addresses."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.zeros(1 << self.bits, values.dtype)
        left, step = np.arange(len(keys)), 0
        while len(left):
            slot = self.slot(keys[left], step)
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.keys[slot[free]] = keys[left[free]]
            done = self.keys[slot] == keys[left]
            self.values[slot[done]] = values[left[done]]
            left, step = left[~done], step + 1

    def slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        return ((keys * _A >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slot(keys, 0)
        out, step = self.values[slot], 0
        left = np.flatnonzero(self.keys[slot] != keys)
        while len(left):
            step += 1
            slot = self.slot(keys[left], step)
            same = self.keys[slot] == keys[left]
            out[left[same]] = self.values[slot[same]]
            left = left[~same]
        return out


def scores(docs: pa.Table, answers: pa.Table, depth: int, parts: int, tokens: int, distinct: int) -> pa.Table:
    """SCORED rows of one chunk."""
    names = [f.split()[0] for f in SCORED.split(", ")]
    if not docs.num_rows:
        return pa.table({n: pa.array([], _kind(n)) for n in names})
    texts = Texts(docs, depth)
    counts, lengths = [], []
    for row in sorted(answers.to_pylist(), key=lambda r: r["part"]):
        body = unsqueezed(row["body"])
        counts.append(np.frombuffer(body, np.uint64, row["n_words"]))
        lengths.append(np.frombuffer(body, np.float32, row["n_grams"], 8 * row["n_words"]))
    lists, _ = texts.words()
    count = np.concatenate(counts).astype(float)
    base = np.log10((count + 0.1) / (tokens + 0.1 * (distinct + 1)))
    # answers have no keys: they come in the order in which the chunk asked
    length, score = Lookup(texts.grams(parts)[1], np.concatenate(lengths)), np.zeros(len(texts.raw))
    for owner, keys, bounds in texts.blocks():
        np.add.at(score, owner, np.add.reduceat(length(keys).astype(float), bounds[:-1]))
    known = count > 0
    size = [len(r) for r in texts.raw]
    cols = {
        "doc_id": texts.ids, "held_out": texts.held, "n_tokens": [len(w) for w in lists],
        "n_known": [int(known[w].sum()) for w in lists], "train_tokens": [tokens] * len(lists),
        "base_score": [float(base[w].sum()) for w in lists], "score": score.tolist(), "n_bytes": size,
        "bits_per_byte": [-s / math.log10(2) / max(1, n) for s, n in zip(score.tolist(), size)]}
    return pa.table({n: pa.array(cols[n], _kind(n)) for n in names})


def _kind(name: str) -> pa.DataType:
    kinds = dict(f.split() for f in SCORED.split(", "))
    return {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kinds[name]]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """SCORED, a row for each row of ``docs``, from a model of those with crc32(id as text) mod 10 not 0."""
    if not 2 <= depth <= 6:
        raise ValueError("a string of 2 to 6 context bytes and one more fits a number")
    sc = docs.sparkSession.sparkContext
    table, parts = chunks.chunk_table(docs, id_col, text_col, CHUNK_BYTES, least=8)
    asked = chunks.each_chunk(table, None, lambda docs, _: ask(docs, depth, parts), ASKED)
    asked = chunks.bucketed(asked, "part", parts)
    by_part = asked.groupBy("part")
    top = by_part.applyInArrow(lambda rows: Part(rows, depth).top(), "code int, below double, n0 long, n1 long")
    # at most 256 * 255 decisions and one row of totals
    upper, tokens, distinct = upper_tree(top.groupBy("code").agg(*(F.sum(c).alias(c) for c in ("below", "n0", "n1"))).collect())
    sent = sc.broadcast(upper)
    # read once, so they are only shuffled; a lost task is worked out again from the written questions
    answers = by_part.applyInArrow(lambda rows: Part(rows, depth).tell(sent.value), TOLD)
    return chunks.each_chunk(table, answers, lambda docs, told: scores(docs, told, depth, parts, tokens, distinct), SCORED)


def op7_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of all ``documents``."""
    return score(common.table(spark, sf_dir, "documents"))
