"""Operator 1: token sequences in training order, as fixed-stride shards.

Texts become token ids (UTF-8 bytes with an end mark by default, or the ids of a public
vocabulary), run together and are cut into sequences of ``length`` tokens. Sequences are
numbered 0 to N - 1: by bucket of documents (a hash of the row), within a bucket by document id.
A keyed Feistel network permutes the numbers of the next larger power of four; numbers that
land at N or beyond walk on through the network until they land below (cycle-walking). So
each sequence has one slot of 0 to N - 1, without a shuffle of the slots and without any state
but the key. Slots in ranges go to the tasks that write them; each shard is one
row of ``shard_rows`` sequences end to end, so slot s lies in shard s // shard_rows at byte
(s % shard_rows) * stride, and reading may resume at any slot.

Nothing depends on how the input is split or on the cluster: the same rows, key and lengths give
the same shards.

Defined results: null and empty texts are documents of an end mark alone; rows with a null id come
first in their bucket; repeated rows are repeated documents; the last sequence of a bucket is
filled with the padding id; an empty table gives no shard. Only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from smogline.session import pin_table

from . import bpe, common

LENGTH, SHARD_ROWS, KEY = 2048, 2048, 20240229
#: Tokens of text that a bucket holds, about.
BUCKET_TOKENS = 4 << 20
ROUNDS = 8
#: Byte tokens: UTF-8 has neither of these bytes.
BYTE_END, BYTE_PAD = 0xFF, 0xFE
SHARD = "shard long, first_slot long, n_sequences int, stride int, fill array<int>, docs array<array<long>>, payload binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each number of 0 .. n - 1: a permutation that the key picks."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mixed(right ^ k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def encoder(tokenizer: str | None):
    """(function from a text to its ids with the end mark, padding id, number type)."""
    if tokenizer is None:
        return lambda t: np.frombuffer(t.encode() + bytes([BYTE_END]), np.uint8), BYTE_PAD, np.uint8
    vocab = bpe.load(tokenizer)
    end = max(vocab.tokens)
    return lambda t: np.append(vocab.encode(t)[0], end).astype(np.uint32), end, np.uint32


def bucket_rows(docs: DataFrame, id_col: str, text_col: str, tokenizer: str | None) -> DataFrame:
    """(bucket, n_tokens, doc_id, text)."""
    rows = common.plain_rows(docs, id_col, text_col)
    if tokenizer is None:
        n_tokens = (F.octet_length("text") + 1).cast("long")
    else:
        @F.pandas_udf("long")
        def count(texts):
            encode = encoder(tokenizer)[0]
            return texts.map(lambda t: len(encode(t)))
        n_tokens = count("text")
    rows = rows.withColumn("n_tokens", n_tokens)
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    return rows.withColumn("bucket", common.hash_part(F.xxhash64("doc_id", "text"), int(total // BUCKET_TOKENS) + 1, "order"))


def sequences(docs: DataFrame, id_col: str, text_col: str, length: int, shard_rows: int, key: int,
              tokenizer: str | None) -> tuple[DataFrame, int]:
    """(slot, fill, docs, payload) of every sequence, and how many there are."""
    rows = bucket_rows(docs, id_col, text_col, tokenizer)
    sizes = rows.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))
    counts = pin_table(sizes.withColumn("n", F.ceil(F.col("n") / length).cast("long")), "buckets")
    n_all = counts.agg(F.sum("n")).first()[0] or 0
    # numbers of the buckets before: pairs of a bucket's block of 1024 and the buckets within
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / 1024))
    within = blocks.selectExpr("bucket", "block", "sum(n) OVER (PARTITION BY block ORDER BY bucket) - n AS inner_base")
    before = blocks.groupBy("block").agg(F.sum("n").alias("n")).selectExpr("block", "sum(n) OVER (ORDER BY block) - n AS outer_base")
    base = within.join(before, "block").selectExpr("bucket", "inner_base + outer_base AS base")
    rows = rows.join(base, "bucket").select("bucket", "base", "doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt = (rows.repartition(common.shuffle_parts(docs.sparkSession), "bucket")
             .sortWithinPartitions("bucket", "doc_id", "tie", "text").drop("tie"))

    def run(batches):
        encode, pad, kind = encoder(tokenizer)
        at = None
        for batch in common.text_slices(batches):
            out = []
            for bucket, base, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    if at is not None:
                        out += open_.close()
                    at, open_ = bucket, _Open(base, length, pad, kind)
                out += open_.add(doc, encode(text))
            yield from _sequence_batches(out, n_all, key)
        if at is not None:
            yield from _sequence_batches(open_.close(), n_all, key)

    return dealt.mapInArrow(run, "slot long, fill int, docs array<long>, payload binary"), n_all


class _Open:
    """The sequence that a bucket is filling."""

    def __init__(self, base: int, length: int, pad: int, kind):
        self.number, self.length, self.pad, self.kind = base, length, pad, kind
        self.parts, self.docs, self.size = [], [], 0

    def add(self, doc, ids):
        out, at = [], 0
        while at < len(ids):
            part = ids[at:at + self.length - self.size]
            self.parts.append(part)
            self.docs.append(doc)
            self.size += len(part)
            at += len(part)
            if self.size == self.length:
                out += self.close()
        return out

    def close(self):
        if not self.size:
            return []
        body = np.full(self.length, self.pad, self.kind)
        body[:self.size] = np.concatenate(self.parts)
        row = (self.number, self.size, self.docs, body.tobytes())
        self.number, self.parts, self.docs, self.size = self.number + 1, [], [], 0
        return [row]


def _sequence_batches(rows, n_all, key):
    if rows:
        number, fill, docs, payload = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots(np.array(number), n_all, key)), pa.array(fill, pa.int32()),
             pa.array(docs, pa.list_(pa.int64())), pa.array(payload, pa.binary())], names=["slot", "fill", "docs", "payload"])


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 shard_rows: int = SHARD_ROWS, key: int = KEY, tokenizer: str | None = None) -> int:
    """Write SHARD rows as Parquet to ``path``; returns the number of sequences."""
    found, n_all = sequences(docs, id_col, text_col, length, shard_rows, key, tokenizer)
    n_shards = -(-n_all // shard_rows)
    tasks = max(1, min(n_shards, common.shuffle_parts(docs.sparkSession)))
    shard = F.floor(F.col("slot") / shard_rows)
    dealt = (found.withColumn("shard", shard)
             .repartitionById(tasks, F.floor(F.col("shard") * tasks / max(1, n_shards)).cast("int"))
             .sortWithinPartitions("slot"))

    def run(batches):
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["shard"] != row["shard"]:
                    yield _shard(held, shard_rows)
                    held = []
                held.append(row)
        if held:
            yield _shard(held, shard_rows)

    dealt.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)
    return n_all


def _shard(rows: list[dict], shard_rows: int) -> pa.RecordBatch:
    first = rows[0]["shard"] * shard_rows
    if [r["slot"] for r in rows] != list(range(first, first + len(rows))):
        raise ValueError(f"shard {rows[0]['shard']} has a gap")
    cols = (rows[0]["shard"], first, len(rows), len(rows[0]["payload"]), [r["fill"] for r in rows], [r["docs"] for r in rows],
            b"".join(r["payload"] for r in rows))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int64())), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)],
                                      names=["shard", "first_slot", "n_sequences", "stride", "fill", "docs", "payload"])


def read_sequences(spark: SparkSession, path: str, from_slot: int = 0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(slot, shard, byte_offset, n_tokens, doc_ids, tokens) from a slot on; earlier shards are not read."""
    shards = spark.read.parquet(path).filter(F.col("shard") >= from_slot // shard_rows)
    each = shards.select("shard", "first_slot", "stride", "fill", "docs", "payload",
                         F.posexplode("fill").alias("place", "n_tokens"))
    at = F.col("place") * F.col("stride")
    return each.select((F.col("first_slot") + F.col("place")).alias("slot"), "shard", at.cast("long").alias("byte_offset"), "n_tokens",
                       F.element_at("docs", F.col("place") + 1).alias("doc_ids"),
                       F.substring("payload", at + 1, F.col("stride")).alias("tokens")).filter(F.col("slot") >= from_slot)


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as shards of byte tokens in training order, read back as digests."""
    from smogline.session import scratch_path
    import uuid

    path = scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    write_shards(common.table(spark, sf_dir, "documents"), path)
    got = read_sequences(spark, path)
    return got.select("slot", "shard", "byte_offset", "n_tokens", "doc_ids", F.sha2("tokens", 256).alias("tokens_sha256"))
