import itertools
import random

import numpy as np

from smogline.llm import decontam
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.001"
ITEMS = [(1, " ".join(f"w{i}" for i in range(30))), (2, "one two three four five six seven eight"),
         (3, "too short to tell"), (4, None), (5, ""), (None, "An item, with no id: but it still has many words here."),
         (2, "one two three four five six seven eight")]


def plain(doc, item):
    """Most equal tokens in any window on any diagonal, if similar enough; short items whole."""
    d, i = decontam.tokens(doc), decontam.tokens(item)
    if len(i) < 8:
        held = d == i if len(i) < 3 else any(d[k:k + len(i)] == i for k in range(len(d)))
        return len(i) if i and held else None
    if len(d) < 8 or sum(t in i for t in d) < 7:  # any window needs seven equal tokens at least
        return None
    same = np.array(d, dtype=object)[:, None] == np.array(i, dtype=object)[None, :]
    best = 0
    for shift in range(8 - len(d), len(i) - 7):
        equal = np.diagonal(same, shift).astype(int)
        w = min(13, len(equal))
        top = int(np.convolve(equal, np.ones(w, int), "valid").max()) if w >= 8 else 0
        best = max(best, top if top >= 0.8 * w else 0)
    return best or None


def check(spark, docs, items, df=None):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.overlaps(df if df is not None else frame(spark, docs), bench).collect()
    want = [(d, i, best) for d, t in docs for i, it in set(items) if (best := plain(t, it)) is not None]
    assert sorted([(r.doc_id, r.item_id, r.equal_tokens) for r in got], key=str) == sorted(want, key=str)
    return got


def test_overlaps_match_brute_force(spark):
    rng = random.Random(2)
    docs = []
    for n in range(150):
        words = [rng.choice(["the", "of", "and", f"w{rng.randrange(30)}", f"x{n}"]) for _ in range(rng.randrange(40))]
        item = decontam.tokens(rng.choice(ITEMS[:2])[1])
        cut = item[rng.randrange(4):len(item) - rng.randrange(4)]
        leak = [w.decode() if rng.random() > 0.13 else "sub" for w in cut]
        docs.append((n, " ".join(words[:10] + (leak if n % 3 else []) + words[10:])))
    assert len(check(spark, docs, ITEMS)) > 20


def test_awkward_rows_and_empty_tables(spark):
    rows = AWKWARD + [(20, ITEMS[0][1].upper().replace(" ", ", ")), (None, "an item with no id but it still HAS many words here")]
    check(spark, rows, ITEMS)
    check(spark, [], ITEMS, frame(spark, []))
    check(spark, rows, [], frame(spark, rows))


def test_short_items_and_passages_cut_at_an_edge(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = [(1, item), (2, "what is the capital of this country"), (3, "yes"), (4, "forty two"), (5, "a b c"), (6, " .,; ")]
    words = item.split()
    docs = [(1, " ".join(words[:12])), (2, " ".join(words[5:]) + " and so on it goes with other words here"), (3, " ".join(words[:7])),
            (4, "and so on " + " ".join(words[:8])), (5, "and so on " + " ".join(words[:6]) + " x"), (6, "He asked: What is the capital of this country?"),
            (7, "what is the largest capital of this country"), (8, "Yes!"), (9, "yes it is forty two"), (10, "Forty-two"), (11, "x a b c d"), (12, "a b")]
    for block in (decontam.BLOCK_BYTES, 40):  # 40: several blocks
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        got = check(spark, docs, items)
        assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (4, 1), (6, 2), (8, 3), (10, 4), (11, 5)}
        kept = decontam.without_overlaps(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
        assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 7, 9, 12]


def test_masks_lose_no_window():
    for w in range(8, 14):
        for miss in itertools.chain.from_iterable(itertools.combinations(range(w), m) for m in range(w // 5 + 1)):
            assert any(all(o + i not in miss for i, c in enumerate(m) if c == "1")
                       for m in decontam.MASKS for o in range(w - len(m) + 1))


def test_clean_rows_keep_their_columns(spark):
    rows = AWKWARD + [(20, "Intro. " + ITEMS[0][1])]
    df = frame(spark, rows)
    kept = decontam.without_overlaps(df, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.schema == df.schema
    assert sorted(kept.collect(), key=str) == sorted(df.filter("doc_id is null or doc_id <> 20").collect(), key=str)


def test_query_over_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{TABLE}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in decontam.op2_decontamination(spark, TABLE).collect()}
    # brute force on sets first: only pairs with some shared tokens can overlap
    sets = [(d, t, set(decontam.tokens(t))) for d, t in docs]
    want = set()
    for i, text in items:
        mine = set(decontam.tokens(text))
        want |= {(d, i) for d, t, s in sets if len(s & mine) >= 6 and plain(t, text) is not None}
    assert got == want and got
