import hashlib

import numpy as np

from smogline.llm import bpe, order
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.001"


def test_slots_permute():
    for n in (1, 2, 3, 5, 64, 65, 1000, 4097):
        a, b = (order.slots(np.arange(n), n, k) for k in (1, 2))
        assert sorted(a) == sorted(b) == list(range(n))
        assert n < 60 or list(a) != list(b)
    assert list(order.slots(np.array([7, 3]), 1000, 1)) == list(order.slots(np.arange(1000), 1000, 1)[[7, 3]])


def texts_of(rows, length):
    """The documents that sequences hold, from their parts."""
    out, parts = [], {}
    for r in rows:
        assert len(r.tokens) == length and r.n_tokens <= length
        assert all(b == order.BYTE_PAD for b in r.tokens[r.n_tokens:])
    whole = b"".join(bytes(r.tokens[:r.n_tokens]) for r in rows)
    return whole


def test_awkward_rows_round_trip(spark, tmp_path):
    for length, shard_rows in ((64, 8), (1000, 3)):
        path = str(tmp_path / f"s{length}")
        n = order.write_shards(frame(spark), path, length=length, shard_rows=shard_rows, key=5)
        rows = sorted(order.read_sequences(spark, path, 0, shard_rows).collect())
        assert [r.slot for r in rows] == list(range(n))
        assert all(r.shard == r.slot // shard_rows and r.byte_offset == r.slot % shard_rows * length for r in rows)
        numbers = np.argsort(order.slots(np.arange(n), n, 5))  # slot -> number
        whole = texts_of([rows[s] for s in np.argsort(numbers)], length)
        docs = sorted(whole.split(bytes([order.BYTE_END]))[:-1])
        assert docs == sorted((t or "").encode() for _, t in AWKWARD)
        assert {d for r in rows for d in r.doc_ids} == {i for i, _ in AWKWARD}
        tail = sorted(order.read_sequences(spark, path, n // 2, shard_rows).collect())
        assert tail == rows[n // 2:]


def test_vocabulary_ids(spark, tmp_path):
    path = str(tmp_path / "v")
    order.write_shards(frame(spark), path, length=50, shard_rows=7, tokenizer=bpe.DEFAULT_TOKENIZER)
    rows = order.read_sequences(spark, path, 0, 7).collect()
    own = bpe.load(bpe.DEFAULT_TOKENIZER)
    want = sum(len(own.encode(t or "")[0]) + 1 for _, t in AWKWARD)
    assert sum(r.n_tokens for r in rows) == want and all(len(r.tokens) == 200 for r in rows)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "e")
    assert order.write_shards(frame(spark, []), path) == 0
    assert order.read_sequences(spark, path).count() == 0


def test_query_over_the_table(spark):
    got = order.op1_training_order(spark, TABLE).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    rows = spark.read.parquet(f"{TABLE}/documents.parquet").collect()
    assert sum(r.n_tokens for r in got) == sum(len(r.text.encode()) + 1 for r in rows)
    assert {d for r in got for d in r.doc_ids} == {r.doc_id for r in rows}
    assert len({r.tokens_sha256 for r in got}) > 0.8 * len(got) and hashlib.sha256(b"").hexdigest() not in {r.tokens_sha256 for r in got}
