import math

import duckdb
import numpy as np

from smogline.llm import topk

TABLE = "/root/testdata/sf0.001"


def plain(rows, is_query, k):
    def fits(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and fits(v)}
    out = []
    for i, q in whole:
        if is_query(i):
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_small_frame_with_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 4) / 8]) for i in range(60)]
    rows += [(3, rows[3][1]), (100, None), (101, [0.1, None, 0.2, 0.3]), (102, [float("nan")] * 4),
             (103, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (104, [1.0, 2.0]), (20, [9.0] * 4),
             (200, [1e9, 1e9, -1e9, 3.5]), (220, []), (105, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, query_id string")
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), k=7)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 20 == 0, 7)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_the_threshold_stops_early():
    rng = np.random.default_rng(1)
    body = (rng.pareto(1.2, (3000, 6)) * 20).astype(np.int64)
    best = topk.Best(np.array([-1]), np.array([[5, 4, 3, 2, 1, 1]]), 10)
    lists = np.argsort(body, axis=0, kind="stable").T.astype(np.int32)
    scored = topk.threshold_search(best, np.arange(3000), body, lists)
    exact = body @ best.body[0]
    assert scored < 2000
    assert list(best.cand) == list(np.lexsort((np.arange(3000), -exact))[:10])


def test_query_matches_sql(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 100)  # several blocks and groups
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    duckdb.sql(f"create or replace temp view embeddings as select * from '{TABLE}/embeddings.parquet'")
    want = sorted(duckdb.sql(topk.ORACLE).fetchall())
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.op5_topk(spark, TABLE).collect())
    assert got == want and len(got) == 25 * 20


def test_scores_beyond_what_a_double_holds(spark):
    """Whole numbers above 2^53 are told apart, and those beyond a long are held at its end."""
    big = 10_000_000.0
    rows = [(20, [big, big, 1 / 64, 0.0]), (1, [big / 2, big / 2, 34 / 64, 0.0]), (3, [big / 2, big / 2, 36 / 64, 0.0]),
            (2, [big / 2, big / 2, 35 / 64, 7.0]), (5, [-big, 3.0, 0.0, 0.0]), (40, [1e6, -1e7, 0.5, 2.0])]
    rng = np.random.default_rng(8)
    rows += [(100 + int(i), [float(x) for x in rng.integers(-10**7, 10**7, 4)]) for i in range(40)]
    rows += [(3, rows[2][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), k=6)
    want = plain(rows, lambda i: i % 20 == 0, 6)
    assert max(abs(r[3]) for r in want) > 2**53
    assert sorted(map(tuple, got.collect())) == want
    far = [(20, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [1e299, 5.0]), (3, [-1.0, 0.0]), (4, [-1e300, 0.0])]
    df = spark.createDataFrame(far, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id = 20"), k=3).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [
        (1, 1, 2**63 - 1), (2, 2, 2**63 - 1), (3, 3, -2**63)]
