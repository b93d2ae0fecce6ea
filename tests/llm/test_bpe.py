import hashlib
import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from smogline.llm import bpe
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def want(public, text):
    ids = public.encode(text or "", add_special_tokens=False).ids
    return ids, public.decode(ids, skip_special_tokens=False)


def test_awkward_rows(spark, public):
    got = bpe.encode_decode(frame(spark)).collect()
    assert sorted((r.doc_id or 0, list(r.ids), r.decoded) for r in got) == sorted(
        (i or 0, *want(public, t)) for i, t in AWKWARD)


def test_empty_table(spark):
    assert bpe.encode_decode(frame(spark, [])).count() == 0


def test_random_texts_match_the_library(public):
    rng = random.Random(4)
    letters = "abehtns  \n'.,;!#1290ABÉéßΣσİıﬁ日語🙂́ \x1c\x85<|>"
    own = bpe.load(bpe.DEFAULT_TOKENIZER)
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(90)))
        if rng.random() < 0.2:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"]) + text
        ids, decoded = own.encode(text)
        assert (list(ids), decoded) == want(public, text), repr(text)


def test_both_merge_paths_agree(public):
    rng = random.Random(5)
    own = bpe.load(bpe.DEFAULT_TOKENIZER)
    for _ in range(200):
        word = "".join(rng.choice("aenthioslr") for _ in range(rng.randrange(1, 300)))
        raw = word.encode()
        parts = [*(own.inner[b] for b in raw[:-1]), own.final[raw[-1]]]
        assert own._merge_long(list(parts)) == own.encode_word(word) == want(public, word)[0]


def test_query_over_the_table(spark, public):
    docs = duckdb.sql(f"select doc_id, text from '{TABLE}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in bpe.op4_bpe(spark, TABLE).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        ids, decoded = want(public, t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
