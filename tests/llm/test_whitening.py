import math
from fractions import Fraction

import numpy as np

from smogline.llm import whitening


def plain(rows, k=8):
    """By the covariance matrix: {(vec_id, position): (deviation, ...)}, eigenvalues and components."""
    kept = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n = len(kept)
    sums = [sum(col) for col in zip(*(x for _, x in kept))]
    far = [[n * x - s for x, s in zip(r, sums)] for _, r in kept]
    deviation = [sum(f * f for f in r) for r in far]
    centred = np.array([[float(Fraction(f, n)) for f in r] for r in far])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return [i for i, _ in kept], n, deviation, centred, values, vectors


def check(got, rows, k=8):
    ids, n, deviation, centred, values, vectors = plain(rows)
    k = min(k, sum(values > 1e-9 * values[0]))
    assert len(got) == n * k
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error <= 1e-9
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    trace = values.sum()
    want = {}
    for i, d in zip(ids, deviation):
        want[i, d] = want.get((i, d), 0) + k
    assert {key: len(v) for key, v in by.items()} == want
    signs = {}
    for i, d, row in zip(ids, deviation, centred):
        for r in by[i, d]:
            c = r.component - 1
            assert abs(r.explained * trace / values[c] - 1) < 1e-9
            expected = row @ vectors[:, c] / np.sqrt(values[c])
            if abs(expected) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(expected * r.whitened))
            assert abs(abs(expected) - abs(r.whitened)) < 1e-7 * max(1, abs(expected))
    assert all(len(s) == 1 for s in signs.values())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows],
                                 "vec_id long, embedding array<double>, component int, n string, whitened double")


def test_against_the_covariance_matrix(spark):
    rng = np.random.default_rng(3)
    mixing = rng.standard_normal((12, 12))
    rows = [(i, (rng.standard_normal(12) @ mixing + 5).tolist()) for i in range(300)]
    rows += [(3, rows[3][1])] * 100 + [(None, rows[4][1]), (900, None), (901, [None] + [0.5] * 11),
                                       (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0, 2.0]), (905, [])]
    fitting = [(i, v) for i, v in rows if v is None or len(v) == 12]
    check(whitening.whiten(frame(spark, rows).repartition(5)).collect(), fitting)


def test_blocks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 6 * 7)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(6) * [9, 5, 3, 1, 1, 0.2]).tolist()) for i in range(100)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_fewer_components_than_asked_for(spark):
    """Lines and planes: components of no variance are left out."""
    rows = [(i, [i / 4, i / 2, 1.0, 0.0]) for i in range(50)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)
    assert whitening.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(9)])).count() == 0
    assert whitening.whiten(frame(spark, rows).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0


def test_equal_eigenvalues(spark):
    """A cross: every direction has the same variance, so a run ends at once and starts anew."""
    rows = [(2 * j + s, [float((1 - 2 * s) * 3 * (i == j)) for i in range(10)]) for j in range(10) for s in (0, 1)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 20 * 8 and got[0].identity_error < 1e-9
    assert all(abs(r.explained - 0.1) < 1e-9 for r in got)


def test_large_entries(spark):
    rows = [(i, [1e12 * (i % 7), 1e300 if i == 3 else 0.5, float(i)]) for i in range(40)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} or len(got) > 0
    assert got[0].identity_error < 1e-4


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(whitening.op13_whitening(spark, sf).collect(), rows)


def test_wide_rows_stop_when_nothing_is_left(spark, monkeypatch):
    monkeypatch.setattr(whitening, "WIDE", 8)
    steps = []
    gram = whitening.Rows.gram
    monkeypatch.setattr(whitening.Rows, "gram", lambda self, q: (steps.append(1), gram(self, q))[1])
    rng = np.random.default_rng(7)
    scale = 2.0 ** -np.arange(40) * 1000 + 1e-2
    rows = [(i, (rng.standard_normal(40) * scale).tolist()) for i in range(200)]
    check(whitening.whiten(frame(spark, rows), k=3).collect(), rows, k=3)
    assert len(steps) < 40
