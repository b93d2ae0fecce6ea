"""Relational store -> enriched warehouse fact.

Ops: B13 (NaN -> NULL), B14 (incremental extract), B15 (calendar parts),
B16 (null keys), B17 (final projection), B18 (load timestamp),
G1-G3 (dimension lookups), G7 (compliance status).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import calendar as cal
from ..functions.numeric import nan_to_null
from ..schemas import ENRICHED_COLUMNS
from .cleaning import year_bounds
from .joins import checked_broadcasts, lookup
from .upsert import assign_surrogate_keys


def extract_cutoff(since_days: int, today: _dt.date | None = None) -> str:
    """now - N days as a date; N <= 0 means the fixed floor date (op B14)."""
    if since_days and since_days > 0:
        today = today or _dt.date.today()
        return (today - _dt.timedelta(days=since_days)).isoformat()
    return K.EXTRACT_FLOOR_DATE


def incremental_extract(raw: DataFrame, since_days: int = 0, limit: int | None = None,
                        today: _dt.date | None = None) -> DataFrame:
    """Valid, non-null rows at or after the cutoff; optionally only the newest
    ``limit`` (a top-N; ties on ``ts_utc`` broken by ``measurement_sk``)."""
    cutoff = extract_cutoff(since_days, today)
    df = raw.filter(
        (F.col("is_valid") == F.lit(True))
        & F.col("value").isNotNull()
        & (F.col("ts_utc") >= F.lit(cutoff).cast("date").cast("timestamp_ntz"))
    )
    df = year_bounds(df, cutoff)
    if limit is not None:
        df = newest_n(df, limit)
    return df


def newest_n(df: DataFrame, n: int, ts_col: str = "ts_utc", tie_col: str = "measurement_sk") -> DataFrame:
    """The ``n`` newest rows (ties on time by ``tie_col``, both descending).

    Scale-safe top-N: no task ever merges more than one range partition.
    (1) A per-day histogram (one row per calendar day; its running total is a
    window over days, bounded by the calendar) gives the latest day at or after
    which at least ``n`` rows lie; rows before it cannot be in the answer and
    are filtered out (one scalar reaches the driver). (2) The remaining rows are
    numbered newest first by the range-partitioned surrogate-key path (per
    partition counts and offsets, no global window) and the first ``n`` kept.
    A plain ``orderBy().limit()`` would send every partition's own top ``n``
    to one task for the final merge."""
    days = df.groupBy(F.date_trunc("day", ts_col).cast("timestamp_ntz").alias("_d")) \
             .agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(Window.orderBy(F.col("_d").desc())
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = days.withColumn("_c", running).filter(F.col("_c") >= n).agg(F.max("_d").alias("d")).first()["d"]
    if cut is not None:
        df = year_bounds(df.filter(F.col(ts_col) >= F.lit(cut).cast("timestamp_ntz")), cut)
    ranked = assign_surrogate_keys(df, [F.col(ts_col).desc(), F.col(tie_col).desc()], key="_rank")
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def fact_columns(df: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    """Calendar parts, renames and null-key filter of the extracted rows."""
    if loaded_at is None:
        loaded = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(loaded_at, str):
        loaded = F.lit(loaded_at).cast("timestamp_ntz")
    else:
        loaded = loaded_at
    return (
        df.select(
            cal.year_of("ts_utc").alias("year"),
            F.col("ts_utc"),
            cal.quarter("ts_utc").alias("quarter"),
            cal.month_number("ts_utc").alias("month_number"),
            cal.day_of_week_sunday0("ts_utc").alias("day_of_week"),
            F.col("measurement_sk").cast("bigint").alias("measurement_sk"),
            F.col("value").cast("double").alias("measurement_value"),
            F.col("unit").alias("measurement_unit"),
            F.col("source").alias("measurement_source"),
            F.col("is_valid").cast("boolean").alias("is_valid"),
            F.col("pollutant_id").cast("string").alias("pollutant_id"),
            F.col("station_id").cast("int").alias("station_id"),
            F.col("inserted_at"),
            F.col("processed_at"),
            loaded.alias("etl_loaded_at"),
        )
        .filter(F.col("pollutant_id").isNotNull() & F.col("station_id").isNotNull())
    )


def compliance_status(value, daily, annual) -> Column:
    """Daily limit first, then annual; a NULL limit never flags (op G7).
    Limits must already be NaN-free (NaN > x is true in Spark)."""
    v, d, a = (F.col(x) if isinstance(x, str) else x for x in (value, daily, annual))
    return (
        F.when(d.isNotNull() & (v > d), F.lit(K.STATUS_DAILY))
        .when(a.isNotNull() & (v > a), F.lit(K.STATUS_ANNUAL))
        .otherwise(F.lit(K.STATUS_OK))
    )


def pollutant_dim(pollutants: DataFrame) -> DataFrame:
    return pollutants.select(
        F.col("pollutant_id").cast("string").alias("pollutant_id"),
        F.col("name").alias("pollutant_name"),
        F.col("default_unit").alias("pollutant_default_unit"),
        nan_to_null("who_daily_limit").alias("who_daily_limit"),
        nan_to_null("who_annual_limit").alias("who_annual_limit"),
    )


def station_dim(stations: DataFrame) -> DataFrame:
    return stations.select(
        F.col("station_id").cast("int").alias("station_id"),
        "station_code", "station_name", "station_type", "authority",
        nan_to_null("lat").alias("station_latitude"),
        nan_to_null("lon").alias("station_longitude"),
        F.col("years_min").cast("int").alias("station_start_year"),
        F.col("years_max").cast("int").alias("station_end_year"),
        F.col("zone_id").cast("int").alias("zone_id"),
    )


def zone_dim(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("zone_id").cast("int").alias("zone_id"),
        "zone_code", "zone_name", "city_code", "city_name",
        F.col("population").cast("int").alias("zone_population"),
        nan_to_null("centroid_lat").alias("zone_centroid_lat"),
        nan_to_null("centroid_lon").alias("zone_centroid_lon"),
    )


def enrich(fact: DataFrame, pollutants: DataFrame, stations: DataFrame,
           zones: DataFrame) -> DataFrame:
    """Left lookups of the three catalogues plus the compliance status.
    Joins run on integer keys; the station key becomes text only in the output."""
    p, s, z = checked_broadcasts([pollutant_dim(pollutants), station_dim(stations), zone_dim(zones)])
    df = lookup(fact, p, "pollutant_id", checked=True)
    df = lookup(df, s, "station_id", checked=True)
    df = lookup(df, z, "zone_id", checked=True)
    return df.withColumn(
        "who_compliance_status",
        compliance_status("measurement_value", "who_daily_limit", "who_annual_limit"),
    )


def warehouse_projection(df: DataFrame) -> DataFrame:
    """36 ordered, typed columns; boolean validity as 1/0 with NULL -> 0 (op B17)."""
    cols = []
    for name, typ in ENRICHED_COLUMNS:
        if name == "measurement_timestamp":
            c = F.col("ts_utc").cast(typ)
        elif name == "is_valid":
            c = F.when(F.col("is_valid") == F.lit(True), F.lit(1)).otherwise(F.lit(0)).cast("int")
        else:
            c = F.col(name).cast(typ)
        cols.append(c.alias(name))
    return df.select(*cols)


def enriched_fact(raw: DataFrame, pollutants: DataFrame, stations: DataFrame,
                  zones: DataFrame, since_days: int = 0, limit: int | None = None,
                  loaded_at: Column | str | None = None,
                  today: _dt.date | None = None) -> DataFrame:
    """The whole flagship plan: extract -> enrich -> 36-column projection."""
    extracted = incremental_extract(raw, since_days, limit, today)
    return warehouse_projection(enrich(fact_columns(extracted, loaded_at),
                                       pollutants, stations, zones))
