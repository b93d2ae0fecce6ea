import random

import duckdb

from smogline.llm import lines
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.01"


def plain(rows, min_chars):
    """By definition: a line goes if a run of lines around it, long enough, also stands earlier. Distinct ids."""
    rows = [(i, t.split("\n")) for i, t in rows if t is not None]
    places = sorted((i is None, i or 0, k) for k, (i, _) in enumerate(rows))
    order = {k: n for n, (_, _, k) in enumerate(places)}
    first, gone = {}, {k: set() for k in range(len(rows))}
    for k in sorted(order, key=order.get):
        body = rows[k][1]
        for a in range(len(body)):
            for b in range(a, len(body)):
                run = "\n".join(body[a:b + 1])
                if len(run) + 1 >= min_chars:
                    here = (order[k], a)
                    if first.setdefault((b - a, run), here) < here:
                        gone[k] |= set(range(a, b + 1))
    return sorted([(i, len(body), len(gone[k]), "\n".join(x for n, x in enumerate(body) if n not in gone[k]))
                   for k, (i, body) in enumerate(rows)], key=str)


def query(df, min_chars):
    got = lines.drop_repeated(df, min_chars=min_chars).collect()
    return sorted([(r.doc.doc_id, r.n_lines, r.n_removed, r.kept) for r in got if r.kept is not None], key=str)


def test_random_sequences_match_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for n in range(70):
        body = [rng.choice(["", "a", "bb", "ccc ccc", "dddd", f"own {n}"]) for _ in range(rng.randrange(1, 12))]
        if rows and rng.random() < 0.4:
            body += rng.choice(rows)[1].split("\n")
        rows.append((n * 9 % 70 - 30, "\n".join(body)))
    rows.append((None, rows[3][1]))
    for min_chars in (1, 6, 17):
        assert query(frame(spark, rows), min_chars) == plain(rows, min_chars)


def test_places_of_largest_ids_and_of_none(spark):
    line = "a line of text that is long enough to count as a run of its own"
    rows = [(None, f"{line}\nnone {n}") for n in range(6)] + [(2**63 - 1, f"{line}\nlast"), (-2**63, f"first\n{line}\nanother such {line}")]
    rows += [(2**63 - 1, f"another such {line}")]
    got = {(r.doc.doc_id, r.doc.text): r.kept for r in lines.drop_repeated(frame(spark, rows)).collect()}
    assert got == {(None, rows[n][1]): f"none {n}" for n in range(6)} | {rows[6]: "last", rows[7]: rows[7][1], rows[8]: ""}


def test_awkward_rows(spark):
    got = lines.drop_repeated(frame(spark)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc.doc_id, []).append(r)
    assert len(got) == len(AWKWARD)
    assert by[2][0].kept is None and by[2][0].n_lines == 0
    assert by[1][0].n_removed == 0 and by[3][0].kept == ""
    assert [r.kept for r in by[5]] == ["", ""] and [r.n_removed for r in by[5]] == [2, 2]
    assert by[6][0].kept == dict(AWKWARD)[6] and got[0].doc.asDict().keys() == set(frame(spark).columns)
    assert lines.drop_repeated(frame(spark, [])).count() == 0


def test_query_matches_sql(spark):
    duckdb.sql(f"create or replace temp view documents as select * from '{TABLE}/documents.parquet'")
    want = sorted(duckdb.sql(lines.ORACLE).fetchall())
    got = sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in lines.op9_line_dedup(spark, TABLE).collect())
    assert got == want and sum(r[2] for r in got) > 100


def test_plan_is_native(spark):
    plan = lines.op9_line_dedup(spark, TABLE)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
