"""Descriptive statistics of a measurement set (ops E2-E7, E9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal


def describe_by_pollutant(df: DataFrame) -> DataFrame:
    """count, mean, min, max, sample std per pollutant, rounded to 2 (op E2)."""
    v = F.col("value")
    return df.groupBy("pollutant_id").agg(
        F.count(v).alias("count"),
        F.round(F.avg(v), 2).alias("mean"),
        F.round(F.min(v), 2).alias("min"),
        F.round(F.max(v), 2).alias("max"),
        F.round(F.stddev_samp(v), 2).alias("std"),
    )


def time_span(df: DataFrame) -> DataFrame:
    """First and last timestamp and whole elapsed days (op E3)."""
    span = df.agg(F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"))
    return span.withColumn("days", cal.whole_days_between("first_ts", "last_ts"))


def distinct_stations(df: DataFrame) -> DataFrame:
    """Exact distinct station count (op E4)."""
    return df.agg(F.count_distinct("station_id").alias("unique_stations"))


def top_stations(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` stations with most rows; ties by station id (op E5). A top-k report."""
    counts = df.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_measurements"))
    return counts.orderBy(F.col("n_measurements").desc(), F.col("station_id").asc()).limit(n)


def rows_per_year(df: DataFrame) -> DataFrame:
    """Op E6."""
    return df.groupBy(cal.year_of("ts_utc").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


def base_vs_projected(df: DataFrame, base_end_year: int) -> DataFrame:
    """Totals split at the last observed year (op E7)."""
    y = F.year("ts_utc")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(y <= base_end_year).alias("base_records"),
        F.count_if(y > base_end_year).alias("projected_records"),
    )


def dataset_summary(df: DataFrame, year_col: str = "year", station_col: str = "station_id",
                    pollutant_col: str = "pollutant_id") -> DataFrame:
    """Rows, year span, distinct stations and the sorted pollutant list (op E9).
    The set of pollutants is a catalogue-size aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(year_col).cast("int").alias("first_year"),
        F.max(year_col).cast("int").alias("last_year"),
        F.count_distinct(station_col).alias("n_stations"),
        F.array_join(F.sort_array(F.collect_set(pollutant_col)), ",").alias("pollutants"),
    )
