"""Texts in chunks, and questions that chunks put to the rest of the corpus.

A chunk holds the documents whose hash falls to it, a few megabytes. It sums up what it
holds, asks about that under a hash part, and gets the answers back by chunk: a value that a
third of all documents share is asked about once by each chunk, however often it occurs there. The
texts themselves are dealt out once, into a bucketed table in the shared folder; later
passes read each bucket where it lies and only questions and answers are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from smogline.session import pin_table, scratch_path

from . import common

CHUNK_BYTES = 2 << 20
#: Bytes of text that one hash part answers for, roughly.
PART_BYTES = 16 << 20
QUESTION = "part int, chunk int, n int, body binary"
ANSWER = "chunk int, part int, level int, n int, body binary"


def chunk_table(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES,
                least: int | None = None, least_part: int = 0) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text) as a table bucketed by chunk, and the number of hash parts. A small input has ``least``
    chunks, by default two a bucket, and a part for each ``least_part`` bytes, by default one for each shuffle partition."""
    spark = docs.sparkSession
    rows = common.plain_rows(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    shuffle = common.shuffle_parts(spark)
    buckets = max(shuffle, int(total // (4 * CHUNK_BYTES)) + 1)
    chunks = max(least or 2 * buckets, int(total // chunk_bytes) + 1)
    rows = rows.withColumn("chunk", common.hash_part(F.xxhash64("doc_id", "text"), chunks, "chunk"))
    few = min(shuffle, int(total // least_part) + 1) if least_part else shuffle
    return bucketed(rows, "chunk", buckets), max(few, int(total // PART_BYTES) + 1)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder so that grouping by ``key`` needs no further shuffle."""
    spark, name = df.sparkSession, f"smogline_{key}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).option("compression", "zstd")
     .option("path", scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def ask(chunks: DataFrame, answers: DataFrame | None, question: Callable, reply: Callable, schema: str = ANSWER) -> DataFrame:
    """One round: ``question(docs, answers)`` for each chunk gives QUESTION rows, ``reply(rows)``
    for each part gives ANSWER rows (or others, by ``schema``). Written to the shared folder."""
    asked = each_chunk(chunks, answers, question, QUESTION)
    return pin_table(asked.groupBy("part").applyInArrow(reply, schema), "answers")


def each_chunk(chunks: DataFrame, answers: DataFrame | None, fn: Callable, schema: str) -> DataFrame:
    """``fn(docs, answers)`` for each chunk, both as Arrow tables."""
    if answers is None:
        def alone(docs):
            return fn(docs, None)
        return chunks.groupBy("chunk").applyInArrow(alone, schema)

    def both(docs, told):
        return fn(docs, told)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(both, schema)


def question_rows(chunk: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
    """QUESTION rows of one chunk from (part, n, body)."""
    part, n, body = zip(*rows) if rows else ((), (), ())
    return pa.table({"part": pa.array(part, pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int32()),
                     "n": pa.array(n, pa.int32()), "body": pa.array(body, pa.binary())})


def answer_rows(part: int, level: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
    """ANSWER rows of one part from (chunk, n, body)."""
    chunk, n, body = zip(*rows) if rows else ((), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int32()), "part": pa.array([part] * len(rows), pa.int32()),
                     "level": pa.array([level] * len(rows), pa.int32()), "n": pa.array(n, pa.int32()),
                     "body": pa.array(body, pa.binary())})


def told(answers: pa.Table, level: int) -> list[tuple[int, bytes]]:
    """(n, body) of one level's answers in the order of parts."""
    rows = sorted((r["part"], r["n"], r["body"]) for r in answers.to_pylist() if r["level"] == level)
    return [(n, body) for _, n, body in rows]
