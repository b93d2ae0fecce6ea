"""Operator 4: BPE encoding and decoding with a contiguous rank array per word.

A short word is an array of parts and, beside it, the array of the merge ranks of
adjacent parts. Each step scans the ranks for their minimum (the leftmost one among
equals), joins the two parts there, deletes the boundary and refreshes the two
neighbouring ranks. Long words, where scanning would cost the square of the length,
take the same merges from a heap. The vocabulary is a public tokenizer file of the
``tokenizers`` library with word ends, lower case and byte-level characters; it is named by a
parameter and opened by each Python worker once.

Defined results: a null text counts as empty and gives no ids and an empty decoded
text; a null id is kept; repeated rows give repeated results; every text is encoded
whole; an empty table gives an empty result. Only the two named columns are read, so
further columns may have any name.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import common

DEFAULT_TOKENIZER = "word_bpe_49k.json"
#: Parts of a word from which on merges come from a heap.
LONG_WORD = 48
#: Words that a Python worker remembers; when full, the memory starts anew. Longer words are not remembered, so
#: it holds a bounded number of bytes.
CACHE_WORDS, CACHE_LENGTH = 150_000, 64
NO_RANK = 1 << 60


def tokenizer_path(name: str) -> str:
    """An absolute path as it is; any other name is looked up among the public tokenizers."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec.get("decoder"):
            raise ValueError("expected a BPE vocabulary with word ends and no decoder")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        letters = byte_alphabet()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + end] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.memory = _Memory(self)

    def merge(self, parts: list[int]) -> list[int]:
        """Apply the merges to a word's parts."""
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        merges = self.merges
        found = [merges.get(p) for p in zip(parts, parts[1:])]
        ranks = [f[0] if f else NO_RANK for f in found]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            parts[i] = merges[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i:
                f = merges.get((parts[i - 1], parts[i]))
                ranks[i - 1] = f[0] if f else NO_RANK
            if i < len(ranks):
                f = merges.get((parts[i], parts[i + 1]))
                ranks[i] = f[0] if f else NO_RANK
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        merges, n = self.merges, len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(f[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (f := merges.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = merges[a, b][1], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (f := merges.get((parts[left], parts[right]))):
                    heapq.heappush(heap, (f[0], left, parts[left], parts[right]))
        return [p for p, x in zip(parts, alive) if x]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        return self.merge([*(self.inner[b] for b in raw[:-1]), self.final[raw[-1]]])

    def decode(self, ids) -> str:
        """Token texts joined by one space, special tokens included; the vocabulary has no decoder."""
        return " ".join([self.tokens[i] for i in ids])

    def normal(self, text: str) -> str:
        """NFC, then each character's own lower case (a capital sigma knows no word end)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[str]:
        """The words of a text in order; special tokens are cut out of the raw text first."""
        if "<|" not in text or not (found := list(self.marks.finditer(text))):
            return self.words.findall(self.normal(text))
        out, at = [], 0
        for m in found:
            out += self.words.findall(self.normal(text[at:m.start()]))
            out.append(_Special(m.group()))
            at = m.end()
        return out + self.words.findall(self.normal(text[at:]))

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """(ids, decoded text)."""
        memory = self.memory
        got = [memory[p] for p in self.pieces(text)]
        ids = np.frombuffer(b"".join([g[0] for g in got]), dtype=np.int32)
        return ids, " ".join([g[1] for g in got])


class _Special(str):
    """A special token among the words; never equal to a word of the same letters."""

    __slots__ = ()

    def __hash__(self):
        return hash(("special", str(self)))

    def __eq__(self, other):
        return isinstance(other, _Special) and str.__eq__(self, other)


class _Memory(dict):
    """word -> (its ids as bytes, its decoded text)."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word):
        bpe = self.bpe
        ids = [bpe.special[str(word)]] if isinstance(word, _Special) else bpe.encode_word(word)
        got = np.array(ids, dtype=np.int32).tobytes(), bpe.decode(ids)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


_LOADED: dict[str, WordBpe] = {}


def load(tokenizer: str) -> WordBpe:
    """The vocabulary, read once by each process."""
    path = tokenizer_path(tokenizer)
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(doc_id long, ids array<int>, decoded string) for each row, without a shuffle."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(tokenizer)
        got = [bpe.encode(t) for t in batch.column(1).to_pylist()]
        sizes = np.array([0, *(len(ids) for ids, _ in got)])
        values = np.concatenate([ids for ids, _ in got]) if got else np.zeros(0, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(values, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([d for _, d in got], pa.string())],
                                          names=["doc_id", "ids", "decoded"])

    return common.map_text(common.plain_rows(docs, id_col, text_col), run,
                           "doc_id long, ids array<int>, decoded string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest columns of the encoded and decoded ``documents``."""
    got = encode_decode(common.table(spark, sf_dir, "documents"))
    return got.selectExpr("doc_id", "cast(size(ids) as long) AS n_tokens",
                          "sha2(array_join(ids, ' '), 256) AS ids_sha256",
                          "sha2(decoded, 256) AS decoded_sha256")
