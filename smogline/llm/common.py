"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text handled at once inside a task; a longer text forms a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark so that any store it can reach will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string): only the two named columns, a null text read as empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        n = batch.num_rows
        if n == 0:
            continue
        sizes = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < n:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over slices of the rows, within the partitions as they are (no shuffle)."""
    def run(batches):
        for part in text_slices(batches):
            yield fn(part)
    return df.mapInArrow(run, schema)


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a string column in one array, offsets of its n + 1 bounds)."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if col.null_count:
        col = col.fill_null("")
    bounds = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_place(id_col: str, *others: str) -> Column:
    """A row's place by id (null last) and then by a hash of id and ``others``, as one number: rows that
    agree in all of these have the same place, and rows with a null id have places of their own."""
    by_id = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    low = F.xxhash64(F.col(id_col).cast("long"), *(F.col(c).cast("string") for c in others)).bitwiseAND(F.lit(2**62 - 1))
    # 64 bits of id and 62 of the hash: below 10^38
    return ((by_id * F.lit(2**62).cast("decimal(19,0)")).cast("decimal(38,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def hash_part(col: Column, parts: int, seed: str = "part") -> Column:
    """0 .. parts - 1 from a value's hash; independent of the hash that a shuffle uses."""
    return F.pmod(F.xxhash64(F.lit(seed), col), F.lit(parts)).cast("int")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
