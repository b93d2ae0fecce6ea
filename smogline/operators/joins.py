"""Dimension lookups with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A catalogue side is broadcast only when it has at most this many rows and its
# measured payload is at most this many bytes. Zones, pollutants and stations are
# catalogues (thousands of rows); the bounds keep a runaway dimension, or one
# with long texts, from being collected and shipped to every executor.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
          T.DateType: 4, T.DecimalType: 16}


def row_bytes(df: DataFrame) -> Column:
    """Payload bytes of a row: text and binary by their actual length, atomic
    values by their fixed width, nested values by their JSON text."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_WIDTH.get(type(f.dataType), 8)))
    out = F.lit(8)  # per-row overhead
    for p in parts:
        out = out + p
    return out.cast("long")


def checked_broadcasts(dims: list[DataFrame], max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> list[DataFrame]:
    """A broadcast hint for each dimension whose row count and payload bytes,
    measured by one job for all of them, are within the bounds; the others stay plain
    frames (shuffle join, which AQE may still convert at run time from measured
    shuffle sizes). Counts and sums are combined in each task first, so no task
    receives rows."""
    if not dims:
        return []
    parts = [d.agg(F.count(F.lit(1)).alias("n"),
                                       F.coalesce(F.sum(row_bytes(d)), F.lit(0)).alias("b"))
             .select(F.lit(i).alias("i"), "n", "b")
             for i, d in enumerate(dims)]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    size = {r["i"]: (r["n"], r["b"]) for r in counts.collect()}  # one row per dimension
    return [F.broadcast(d) if size[i][0] <= max_rows and size[i][1] <= max_bytes else d
            for i, d in enumerate(dims)]


def checked_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``checked_broadcasts`` for one dimension (a catalogue scan or a local relation)."""
    return checked_broadcasts([dim], max_rows, max_bytes)[0]


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS, checked: bool = False) -> DataFrame:
    """Join a dimension; ``checked=True`` means the caller already applied the
    size check (``checked_broadcasts``)."""
    return fact.join(dim if checked else checked_broadcast(dim, max_rows), on=on, how=how)
