import random

import numpy as np
import xxhash

from smogline.llm import golay, simhash
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(fps):
    """{fp: set of fps reachable}, over all pairs."""
    left, groups = set(fps), []
    while left:
        todo, group = [left.pop()], set()
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if bin(x ^ y).count("1") <= 3}
            left -= near
            todo += near
        groups.append(group)
    return groups


def want(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    out = []
    for group in plain_components([f for _, f in fps]):
        ids = [i for i, f in fps if f in group and i is not None]
        out += [(i, f"{f:016x}", min(ids, default=None)) for i, f in fps if f in group]
    return sorted(out, key=str)


def query(df):
    got = simhash.near_duplicates(df).collect()
    return sorted([(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got], key=str)


def test_awkward_rows(spark):
    assert query(frame(spark)) == want(AWKWARD)


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_golay_code_is_perfect():
    words = np.array([0, 5, 1 << 22, 123456, (1 << 23) - 1])
    for w in words:
        near = golay.nearby(np.array([w]), 23)[0]
        for bit in range(23):
            assert golay.decode(np.array([w ^ 1 << bit]))[0] in near
    index = golay.decode(np.arange(1 << 23))
    assert np.all(np.bincount(index, minlength=4096) == 2048)


def test_links_connect_as_all_pairs_do(spark):
    rng = random.Random(6)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.randrange(12)):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
            fps.add(x)
    hot = rng.getrandbits(64)
    fps |= {hot ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(400)}
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    groups = {frozenset(g) for g in plain_components(fps) if len(g) > 1}
    roots = simhash.components(simhash.linked(df, 3), "a", "b").collect()
    got = {}
    for r in roots:
        got.setdefault(r.root, set()).add(int(np.int64(r.node).view(np.uint64)))
    assert {frozenset(g) for g in got.values()} == groups


def test_query_over_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in simhash.op6_simhash(spark, TABLE).collect()], key=str)
    assert got == want(rows)
    assert any(i != c for i, _, c in got)
