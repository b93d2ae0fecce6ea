import hashlib
import random

from smogline.llm import substrings
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.001"


def plain(rows, width=50):
    rows = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, raw in rows:
        if i is not None:
            for k in range(len(raw) - width + 1):
                w = raw[k:k + width]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, raw in rows:
        gone = bytearray(len(raw))
        if i is not None:
            for k in range(len(raw) - width + 1):
                if least[raw[k:k + width]] < i:
                    gone[k:k + width] = b"\1" * width
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def query(df, **settings):
    got = substrings.remove_repeats(df, **settings).collect()
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got], key=str)


def test_random_texts_match_brute_force(spark, monkeypatch):
    rng = random.Random(10)
    rows, pool = [], ["".join(rng.choice("abé ") for _ in range(rng.randrange(20, 140))) for _ in range(12)]
    for n in range(120):
        parts = [rng.choice(pool)[rng.randrange(12):] if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(80)))
                 for _ in range(rng.randrange(6))]
        rows.append((rng.randrange(-50, 200), "".join(parts)))
    rows += [(500, "ab" * 150), (501, "ab" * 90), (502, "a" * 400), (503, "a" * 300)]
    df = frame(spark, rows)
    assert query(df) == plain(rows)
    assert query(df, width=24, qgram=8) == plain(rows, 24)


def test_windows_go_on_over_steps(monkeypatch):
    import pyarrow as pa
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd") for _ in range(n)) for n in (700, 0, 49, 50, 333)]
    docs = pa.table({"chunk": pa.array([0] * 5, pa.int32()), "doc_id": pa.array(range(5), pa.int64()), "text": texts})
    whole = substrings.Runs(docs, 50, 16)
    monkeypatch.setattr(substrings, "STEP", 61)
    cut = substrings.Runs(docs, 50, 16)
    for k in ("first", "stop", "doc", "bucket"):
        assert list(getattr(whole, k)) == list(getattr(cut, k))


def refinement(texts):
    """A chunk whose buckets are all met elsewhere too."""
    import numpy as np
    import pyarrow as pa
    from smogline.llm import chunks
    docs = pa.table({"chunk": pa.array([0] * len(texts), pa.int32()), "doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    got = substrings.Refinement(docs, 50, 16)
    n = len(got.buckets()[0])
    return got, chunks.answer_rows(0, 0, [(0, n, np.packbits(np.ones(n, bool)).tobytes())])


def test_parts_are_even():
    import numpy as np
    rng = random.Random(4)
    got, _ = refinement(["".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(100)])
    held = np.bincount(substrings.part_of(got.buckets()[0], 50), minlength=50)
    assert held.max() < 2 * held.mean()


def test_kinds_of_a_common_bucket_go_to_many_parts():
    import numpy as np
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(60)
    got, answers = refinement([some(100) + passage + some(100) for _ in range(300)])
    key, *_ = got.kinds(answers)
    bucket = got.runs.bucket[got.first]
    values, counts = np.unique(bucket, return_counts=True)
    common = bucket == values[counts.argmax()]
    assert counts.max() > 100 and len(set(substrings.part_of(key[common], 50).tolist())) > 30
    # a side that they share is asked about once, and known to have several kinds
    side, kind = got.sides()
    assert len(set(side.tolist())) == len(side) and (kind & np.uint64(1)).any()
    assert min(len(set(at[common].tolist())) for at in got.side) < 10


def test_several_parts_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substrings, "LEAST_PART", 100)
    rng = random.Random(11)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(40, 140))) for _ in range(8)]
    rows = [(rng.randrange(60), "".join(rng.choice(pool)[rng.randrange(12):] + "".join(rng.choice("abcd ") for _ in range(rng.randrange(60)))
                                       for _ in range(rng.randrange(5)))) for _ in range(80)]
    assert query(frame(spark, rows)) == plain(rows)


def test_awkward_rows(spark):
    rows = AWKWARD + [(12, AWKWARD[0][1])]
    assert query(frame(spark, rows)) == plain(rows)
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_query_over_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in substrings.op10_substrings(spark, TABLE).collect()], key=str)
    assert got == plain(rows) and any(r[2] for r in got)
