import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from smogline.llm import ctw
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.001"


def held(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 10 == 0


def plain(rows, depth):
    """The definition, node by node, with dictionaries."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    words = {k: [*r.lower().split(), b"\n"] for k, (_, r) in enumerate(rows)}
    count = Counter(w for k, (i, _) in enumerate(rows) if held(i) is False for w in words[k])
    n, v = sum(count.values()), len(count)
    nodes, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def steps(raw):
        raw = bytes(depth) + raw + b"\xff"
        for k in range(depth, len(raw)):
            for b in range(8):
                yield raw[k - depth:k], 1 << b | raw[k] >> 8 - b, raw[k] >> 7 - b & 1

    for i, raw in rows:
        if held(i) is False:
            for context, node, bit in steps(raw):
                for d in range(depth + 1):
                    nodes[context[depth - d:], node][bit] += 1
                    if d:
                        children[context[depth - d + 1:], node].add(context[depth - d:])
    kt = {k: math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1) for k, (a, b) in nodes.items()}
    total, share = {}, {}
    for key in sorted(nodes, key=lambda k: -len(k[0])):
        if len(key[0]) == depth:
            total[key] = kt[key]
        else:
            below = sum(total[c, key[1]] for c in children[key])
            total[key] = np.logaddexp(kt[key], below) - math.log(2)
            share[key] = math.exp(kt[key] - np.logaddexp(kt[key], below))

    def p(context, node, bit, d):
        own = nodes.get((context[depth - d:], node), [0, 0])
        mine = (own[bit] + .5) / (sum(own) + 1)
        if d == depth or (context[depth - d - 1:], node) not in nodes:
            return mine
        w = share[context[depth - d:], node]
        return w * mine + (1 - w) * p(context, node, bit, d + 1)

    out = []
    for k, (i, raw) in enumerate(rows):
        base = sum(math.log10((count[w] + .1) / (n + .1 * (v + 1))) for w in words[k])
        model = sum(math.log10(p(c, node, bit, 0)) for c, node, bit in steps(raw))
        out.append((i, held(i), len(words[k]), sum(count[w] > 0 for w in words[k]), n, base, model))
    return out


def check(spark, rows, depth, df):
    got = sorted([tuple(r)[:7] for r in ctw.score(df, depth=depth).collect()], key=str)
    want = sorted(plain(rows, depth), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=2e-5)


def test_awkward_rows_match_the_definition(spark):
    rows = [(i, t[:600] if t else t) for i, t in AWKWARD]
    check(spark, rows, 3, frame(spark, rows))
    check(spark, rows[:4], 2, frame(spark, rows[:4]))
    assert ctw.score(frame(spark, [])).count() == 0


def test_nothing_to_learn_from(spark):
    rows = [(i, "abc") for i in range(40) if held(i)] + [(None, "abc")]
    check(spark, rows, 4, frame(spark, rows))


def test_default_depth_sees_six_bytes(spark):
    rows = [(i, ("a12345x" if i % 2 else "b12345y") * 6) for i in range(30)]
    got = sorted((r.doc_id, round(r.score, 3)) for r in ctw.score(frame(spark, rows)).collect())
    assert got == sorted((w[0], round(w[6], 3)) for w in plain(rows, 6))
    assert got != sorted((w[0], round(w[6], 3)) for w in plain(rows, 4))


def test_blocks_and_pieces_change_nothing(monkeypatch):
    rows = [(i, " ".join(f"{'ab' * (i % 3)}{j % 7}" for j in range(i * 9))) for i in range(14)] + [(None, "ab0 ab1"), (3, "")]
    # texts cut within words, trees of one pair of bytes each; called here, as tasks would not see the small blocks
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 50)
    monkeypatch.setattr(ctw, "BLOCK_GRAMS", 1)
    depth, parts = 4, 3
    docs = [pa.table({"chunk": pa.array([c] * len(rows[c::2]), pa.int32()), "doc_id": pa.array([i for i, _ in rows[c::2]], pa.int64()),
                      "text": [t for _, t in rows[c::2]]}) for c in range(2)]
    asked = pa.concat_tables([ctw.ask(d, depth, parts) for d in docs])
    held_by = [ctw.Part(asked.filter(pc.equal(asked["part"], p)), depth) for p in range(parts)]
    sums = defaultdict(lambda: np.zeros(3))
    for part in held_by:
        for r in part.top().to_pylist():
            sums[r["code"]] += [r["below"], r["n0"], r["n1"]]
    upper, tokens, distinct = ctw.upper_tree({"code": c, "below": v[0], "n0": v[1], "n1": v[2]} for c, v in sums.items())
    told = pa.concat_tables([part.tell(upper) for part in held_by])
    got = [r for c, d in enumerate(docs) for r in ctw.scores(d, told.filter(pc.equal(told["chunk"], c)), depth, parts, tokens, distinct).to_pylist()]
    got = sorted([tuple(r.values())[:7] for r in got], key=str)
    for g, w in zip(got, sorted(plain(rows, depth), key=str), strict=True):
        assert g[:5] == w[:5] and g[5:] == (pytest.approx(w[5], rel=1e-9), pytest.approx(w[6], rel=1e-6))


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 62, 500, dtype=np.uint64), np.arange(300, dtype=np.uint64)]))
    counts = rng.choice(np.array([0, 1, 7, 254, 255, 256, 1 << 40], dtype=np.uint64), len(keys))
    body = ctw.squeezed(ctw.packed(keys, counts))
    for got, want in zip(ctw.unpacked(ctw.unsqueezed(body), len(keys)), (keys, counts)):
        assert np.array_equal(got, want)
    assert [len(x) for x in ctw.unpacked(memoryview(ctw.packed(keys[:0], counts[:0])), 0)] == [0, 0]


def test_lookup_and_log_gamma():
    keys = np.random.default_rng(0).integers(0, 1 << 40, 5000, dtype=np.uint64)
    keys = np.unique(keys)
    assert np.array_equal(ctw.Lookup(keys, np.arange(len(keys)))(keys[::-1]), np.arange(len(keys))[::-1])
    for x in (0.5, 1, 1.5, 7.5, 8, 100.5, 1e7):
        assert ctw.log_gamma(np.array([x]))[0] == pytest.approx(math.lgamma(x), rel=1e-11, abs=1e-11)


def test_query_over_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()]
    got = {r.doc_id: r for r in ctw.op7_ctw(spark, TABLE).collect()}
    want = {w[0]: w for w in plain([(i, t) for i, t in rows], 0)}
    assert len(got) == len(rows)
    for i, w in want.items():
        assert tuple(got[i])[1:5] == w[1:5] and got[i].base_score == pytest.approx(w[5], rel=1e-9)
    out = [r for r in got.values() if r.held_out and r.n_bytes > 500]
    assert sum(r.bits_per_byte for r in out) / len(out) < 4
