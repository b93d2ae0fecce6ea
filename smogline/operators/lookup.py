"""Table reads of the API: list, page, fetch by key, search (ops I1-I5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ci
from .upsert import assign_surrogate_keys


def list_all(df: DataFrame) -> DataFrame:
    """Op I1."""
    return df.select("*")


# Deepest page end served by a top-k: every partition sends at most this many rows
# to the final merge. Deeper pages are numbered on the range-partitioned path.
DEEP_PAGE_ROWS = 10_000


def page(df: DataFrame, key: str, skip: int = 0, limit: int = 100,
         deep_rows: int = DEEP_PAGE_ROWS) -> DataFrame:
    """Rows ``skip .. skip+limit`` in key order (op I2; the reference had no order).
    A shallow page is a top-k (``offset``/``limit``). A deep one would make every
    partition send ``skip + limit`` rows to one task, so the rows are numbered in
    key order by the range-partitioned surrogate-key path (per-partition offsets,
    no global window) and the page is a filter on that number."""
    if skip + limit <= deep_rows:
        return df.orderBy(F.col(key).asc()).offset(skip).limit(limit)
    ranked = assign_surrogate_keys(df, [F.col(key).asc()], key="_rank")
    return ranked.filter((F.col("_rank") > skip) & (F.col("_rank") <= skip + limit)).drop("_rank")


def fetch(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with ``key == value``; empty means not found (ops I3, I4)."""
    return df.filter(F.col(key) == F.lit(value))


def search(df: DataFrame, col: str, query: str) -> DataFrame:
    """Case-insensitive substring search; an empty query finds nothing (op I5)."""
    return df.filter(contains_ci(col, query))
