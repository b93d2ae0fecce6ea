"""Year selection and per-year load state (ops A4-A7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import UNSET_TOKENS
from ..functions import calendar as cal


def is_set(value) -> bool:
    """A parameter counts as unset when None or one of the unset tokens (any case)."""
    return value is not None and str(value).strip().upper() not in UNSET_TOKENS


def _int(value, name):
    try:
        return int(str(value).strip())
    except (TypeError, ValueError):
        raise ValueError(f"{name} must be a whole number, got {value!r}") from None


def years_to_process(year=None, year_start=None, year_end=None, years=None) -> list[int]:
    """Single year, else inclusive range, else comma list (sorted); the first
    mode that is set wins (op A5)."""
    if is_set(year):
        return [_int(year, "YEAR")]
    if is_set(year_start) and is_set(year_end):
        a, b = _int(year_start, "YEAR_START"), _int(year_end, "YEAR_END")
        if a > b:
            raise ValueError(f"YEAR_START ({a}) is after YEAR_END ({b})")
        return list(range(a, b + 1))
    if is_set(years):
        out = sorted(_int(y, "YEARS") for y in str(years).strip().split(","))
        if not out:
            raise ValueError("YEARS is empty")
        return out
    raise ValueError("set one of YEAR, YEAR_START+YEAR_END or YEARS")


def read_years(spark: SparkSession, path: str, years: list[int], schema=None) -> DataFrame:
    """Parquet dataset partitioned by ``year``; the filter prunes partitions (op A4)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).filter(F.col("year").isin(years))


def requested_years(spark: SparkSession, years: list[int]) -> DataFrame:
    return spark.createDataFrame([(int(y),) for y in years], T.StructType([T.StructField("year", T.IntegerType())]))


def present_years(df: DataFrame, ts_col: str = "ts_utc") -> DataFrame:
    """Distinct years holding rows. A table that carries ``year`` (the partition
    column of the stored facts) is answered from it, so the scan reads no data
    column; otherwise the year comes from the timestamp."""
    if "year" in df.columns:
        return df.select(F.col("year").cast("int").alias("year")).distinct()
    return df.select(cal.year_of(ts_col).alias("year")).distinct()


def years_not_loaded(requested: DataFrame, target: DataFrame, ts_col: str = "ts_utc") -> DataFrame:
    """Requested years with no rows in the target yet (op A6)."""
    return requested.join(present_years(target, ts_col), "year", "left_anti")


def year_status(requested: DataFrame, source: DataFrame, target: DataFrame,
                ts_col: str = "ts_utc") -> DataFrame:
    """Per requested year: skipped (already loaded), failed (no source data) or
    success (op A7). The caller raises on any 'failed' when fail-on-error is set."""
    src = present_years(source, ts_col).withColumn("_src", F.lit(True))
    tgt = present_years(target, ts_col).withColumn("_tgt", F.lit(True))
    # Distinct years: bounded by the calendar span, a few hundred rows at most.
    j = requested.join(F.broadcast(tgt), "year", "left").join(F.broadcast(src), "year", "left")
    return j.select(
        "year",
        F.when(F.col("_tgt").isNotNull(), F.lit("skipped"))
        .when(F.col("_src").isNull(), F.lit("failed"))
        .otherwise(F.lit("success")).alias("status"))


def check_status(status: DataFrame, fail_on_error: bool) -> DataFrame:
    """Continue and report, or stop when ``fail_on_error`` is set and any year
    failed (op A7). The probe reads at most one row."""
    if fail_on_error and status.filter(F.col("status") == "failed").limit(1).count() > 0:
        raise RuntimeError("at least one requested year failed to load")
    return status
