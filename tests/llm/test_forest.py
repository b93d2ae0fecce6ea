import math

import numpy as np

from smogline.llm import forest


def plain(rows, least=0.9):
    """{row number: (vec_id, n_links, component_id, kept)} by comparing all rows."""
    def fits(i, v):
        return i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    live = [k for k, (i, v) in enumerate(rows) if fits(i, v)]
    near = {k: {k} for k in live}
    for dim in {len(rows[k][1]) for k in live}:
        mine = [k for k in live if len(rows[k][1]) == dim]
        x = np.array([rows[k][1] for k in mine], float)
        x = x / np.abs(x).max(axis=1)[:, None]
        size = np.linalg.norm(x, axis=1)
        for a, b in zip(*np.nonzero(x @ x.T >= least * np.outer(size, size))):
            near[mine[a]].add(mine[b])
    root, out = {}, []
    for k in live:
        if k not in root:
            group, todo = {k}, [k]
            while todo:
                new = near[todo.pop()] - group
                group |= new
                todo += new
            name = min(rows[g][0] for g in group)
            root.update(dict.fromkeys(group, name))
    for k, (i, _) in enumerate(rows):
        c = root.get(k, i)
        out.append((i, len(near[k]) - 1 if k in near else 0, c, i == c))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows],
                                 "vec_id long, embedding array<double>, u int, cell string, n double")


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def planted(rng, n, dim, groups, noise):
    rows = rng.standard_normal((n, dim))
    for g in range(groups):
        at = rng.integers(0, n, rng.integers(2, 9))
        rows[at] = rows[at[0]] + noise * rng.random() * rng.standard_normal((len(at), dim))
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(n), rows)]


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = planted(rng, 200, 16, 20, 0.3)
    rows += [(500, rows[7][1]), (7, rows[7][1]), (7, rows[7][1]), (None, rows[7][1]), (501, None), (502, []), (503, [0.0] * 16),
             (504, [float("nan")] * 16), (505, [None] + [1.0] * 15), (506, [float("inf")] * 16), (507, [1.0, 2.0]),
             (508, [2.0, 4.1]), (509, [x * 1e200 for x in rows[3][1]]), (510, [x * 1e-200 for x in rows[3][1]]), (-4, rows[9][1])]
    got = forest.near_duplicates(frame(spark, rows), leaf=1000)
    assert answer(got) == plain(rows)
    assert forest.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert forest.near_duplicates(frame(spark, [(1, None), (2, [0.0])])).count() == 2


def test_crowded_cells_are_dealt_in_blocks(spark):
    """A third of the rows within one dense group that no cut divides."""
    rng = np.random.default_rng(2)
    rows = planted(rng, 400, 12, 10, 0.2)
    centre = rng.standard_normal(12)
    rows += [(1000 + i, (centre + 0.02 * rng.standard_normal(12)).tolist()) for i in range(200)]
    assert answer(forest.near_duplicates(frame(spark, rows), leaf=1000, block=70)) == plain(rows)
    assert answer(forest.near_duplicates(frame(spark, rows), leaf=64, block=30, trees=14)) == plain(rows)


def test_recall_and_no_false_link(spark, monkeypatch):
    """Leaves much smaller than the table, part of them below what the sample shows."""
    monkeypatch.setattr(forest, "SAMPLE", 1500)
    rng = np.random.default_rng(3)
    rows = planted(rng, 6000, 64, 400, 0.35)
    got, want = answer(forest.near_duplicates(frame(spark, rows), leaf=128)), plain(rows)
    links = {r[0]: r[1] for r in want}
    assert sum(links.values()) > 1000
    assert all(r[1] <= links[r[0]] for r in got)
    assert sum(r[1] for r in got) >= 0.97 * sum(links.values())


def test_pairs_count_once_however_many_cells_they_share(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal(20)
    rows = [(i, (base + 0.05 * rng.standard_normal(20)).tolist()) for i in range(300)]
    rows += [(1000 + i, rng.standard_normal(20).tolist()) for i in range(900)]
    x = forest.units([np.array(v) for _, v in rows], 20)
    row, _ = forest.Forest(x, len(x), 0.9, trees=6, leaf=100).deal(x)
    assert len(row) > 8 * len(rows)  # cells overlap
    assert answer(forest.near_duplicates(frame(spark, rows), leaf=100, trees=6)) == plain(rows)


def test_trees_divide():
    rng = np.random.default_rng(5)
    x = forest.units(list(rng.standard_normal((8000, 32))), 32)
    grown = forest.Forest(x, len(x), 0.9, trees=3, leaf=200)
    row, cell = grown.deal(x)
    assert set(row) == set(range(8000))
    assert len(row) < 3 * 8000 * 4
    assert np.unique(cell, return_counts=True)[1].max() <= 400
    thin = forest.Forest(x[:500], len(x), 0.9, trees=3, leaf=200)
    row, cell = thin.deal(x)
    assert set(row) == set(range(8000)) and (thin.deeper > 0).any()
    assert np.unique(cell, return_counts=True)[1].max() <= 1000


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert answer(forest.op12_embedding_near_dedup(spark, sf)) == plain(rows)
