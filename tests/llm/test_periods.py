import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from smogline.llm import periods

from .helpers import AWKWARD, frame


def all_runs(words):
    """By comparing everything: maximal stretches of each lag, those with a smaller period left out."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and not any(a == i and a + b == j + q for a, b, _ in out):
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def found_in(words):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[w] for w in words] + [-1], np.int64)
    return [(s, e - s, q) for s, e, q in periods.runs(ids, np.array([0]), np.array([len(words)]))]


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_many_kinds(seed):
    """Nested, overlapping and broken repetitions of periods on both sides of the scales."""
    rng = np.random.default_rng(seed)
    words = []
    while len(words) < 700:
        block = list(rng.integers(0, rng.choice([1, 2, 3, 50]) + 1, rng.integers(1, 90)))
        if rng.random() < 0.5:
            block = block[:rng.integers(1, 9)] * int(rng.integers(1, 12))
        words += block * int(rng.integers(1, 6)) + block[:rng.integers(0, len(block) + 1)]
        if rng.random() < 0.4:
            words.append(int(1000 + len(words)))
    assert found_in(words) == all_runs(words)


@pytest.mark.parametrize("q", [31, 32, 33, 63, 64, 65, 127, 128, 200])
def test_exactly_three_periods(q):
    rng = np.random.default_rng(q)
    block = list(range(q // 2)) + [7] * (q - q // 2)
    for words in (block * 3, [-5, *block * 3, -6], list(rng.integers(0, 2, q)) * 3):
        assert found_in(words) == all_runs(words)
    assert found_in((block * 3)[:-1]) == all_runs((block * 3)[:-1])


def test_one_word_over_and_over_stays_linear():
    words = ["a"] * 200_000 + ["b"] + ["a", "c"] * 100_000
    # the last "b" and "a" leave two runs
    assert found_in(words) == [(0, 200_000, 1), (200_001, 200_000, 2)]
    marks = periods.seeds(np.zeros(200_000, np.int64), 4096, [(0, 200_000, 1)])
    assert len(marks) == 0


def test_every_row_against_brute_force(spark):
    rows = AWKWARD + [(i, " ".join(f"w{(i * k) % 37}" for k in range(i % 160))) for i in range(20, 140)]
    rows += [(None, "la la\t" * 30), (300, "x y x y\x0b" * 40), (301, "no\x1cbreak " * 26)]
    rows = [(i, t) for i, t in rows if len(t or "") < 20_000]
    got = periods.periodic_runs(frame(spark, rows)).collect()
    want = sorted((plain(i, t) for i, t in rows), key=repr)
    assert sorted((tuple(r)[:8] for r in got), key=repr) == want
    assert sum(r[1] > 0 for r in want) > 5
    assert periods.periodic_runs(frame(spark, rows).limit(0)).count() == 0


def test_slices_do_not_matter(spark, monkeypatch):
    rows = [(i, "one two three four " * (i % 30)) for i in range(60)]
    whole = sorted(map(tuple, periods.periodic_runs(frame(spark, rows)).collect()))
    assert whole == sorted(tuple(periods.described(b)[c][0].as_py() for c in range(10))
                           for b in ([_batch(r) for r in rows]))


def _batch(row):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), pa.array([row[1]])], names=["doc_id", "text"])


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[:8] for r in periods.op11_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        if len(d.text or "") < 9000:
            assert got[d.doc_id] == plain(d.doc_id, d.text)
