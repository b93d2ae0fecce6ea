"""Named queries over the driver tables, each paired with a DuckDB SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLES[name]`` is SQL over the
raw driver tables (views are inlined as CTEs). Names and aliases match column for
column. Queries without a SQL form have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import driver_tables as dt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, views: list[str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = dt.with_views(oracle, views)
        return fn
    return deco

