"""Flagship: the enriched warehouse fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import enrich as E
from ..sources import driver_tables as dt
from .registry import register

# Batch timestamp of the registered run; production passes None (= now).
RUN_LOADED_AT = "2026-01-01 00:00:00"


def nan_null(x: str) -> str:
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


ENRICHED_SQL = f"""
SELECT CAST(year(r.ts_utc) AS INTEGER) AS year,
       r.ts_utc AS measurement_timestamp,
       CAST(quarter(r.ts_utc) AS INTEGER) AS quarter,
       CAST(month(r.ts_utc) AS INTEGER) AS month_number,
       CAST(dayofweek(r.ts_utc) AS INTEGER) AS day_of_week,
       r.measurement_sk, r.value AS measurement_value,
       r.unit AS measurement_unit, r.source AS measurement_source,
       CASE WHEN r.is_valid THEN 1 ELSE 0 END AS is_valid,
       r.pollutant_id, p.name AS pollutant_name, p.default_unit AS pollutant_default_unit,
       {nan_null('p.who_daily_limit')} AS who_daily_limit,
       {nan_null('p.who_annual_limit')} AS who_annual_limit,
       CASE WHEN {nan_null('p.who_daily_limit')} IS NOT NULL
                 AND r.value > {nan_null('p.who_daily_limit')} THEN '{K.STATUS_DAILY}'
            WHEN {nan_null('p.who_annual_limit')} IS NOT NULL
                 AND r.value > {nan_null('p.who_annual_limit')} THEN '{K.STATUS_ANNUAL}'
            ELSE '{K.STATUS_OK}' END AS who_compliance_status,
       CAST(r.station_id AS VARCHAR) AS station_id,
       s.station_code, s.station_name, s.station_type, s.authority,
       {nan_null('s.lat')} AS station_latitude, {nan_null('s.lon')} AS station_longitude,
       s.years_min AS station_start_year, s.years_max AS station_end_year,
       s.zone_id, z.zone_code, z.zone_name, z.city_code, z.city_name,
       z.population AS zone_population,
       {nan_null('z.centroid_lat')} AS zone_centroid_lat,
       {nan_null('z.centroid_lon')} AS zone_centroid_lon,
       r.inserted_at, r.processed_at,
       TIMESTAMP '{RUN_LOADED_AT}' AS etl_loaded_at
FROM readings r
LEFT JOIN pollutants p ON r.pollutant_id = p.pollutant_id
LEFT JOIN stations s ON r.station_id = s.station_id
LEFT JOIN zones z ON s.zone_id = z.zone_id
WHERE r.is_valid AND r.value IS NOT NULL AND r.ts_utc >= DATE '{K.EXTRACT_FLOOR_DATE}'
  AND r.pollutant_id IS NOT NULL AND r.station_id IS NOT NULL
"""


def enriched_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enriched_fact(
        dt.readings(spark, sf_dir), dt.pollutants(spark), dt.stations(spark, sf_dir),
        dt.zones(spark, sf_dir), since_days=0, limit=None, loaded_at=RUN_LOADED_AT)


register("enriched_fact", ENRICHED_SQL)(enriched_from)


EXTRACT_COLS = ["measurement_sk", "station_id", "pollutant_id", "ts_utc", "value"]
TOP_N, SINCE_DAYS = 500, 5

EXTRACT_SQL = f"""
SELECT measurement_sk, station_id, pollutant_id, ts_utc, value
FROM readings
WHERE is_valid AND value IS NOT NULL AND ts_utc >= DATE '{K.EXTRACT_FLOOR_DATE}'
"""


@register("incremental_extract", EXTRACT_SQL)
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract from the floor date on, without a row limit (op B14)."""
    return E.incremental_extract(dt.readings(spark, sf_dir)).select(*EXTRACT_COLS)


@register("incremental_extract_since_days", f"""
SELECT measurement_sk, station_id, pollutant_id, ts_utc, value
FROM readings
WHERE is_valid AND value IS NOT NULL
  AND ts_utc >= (SELECT CAST(max(ts_utc) AS DATE) - {SINCE_DAYS} FROM readings)
""")
def incremental_extract_since_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract of the last days, counted back from the newest row's day (op B14)."""
    raw = dt.readings(spark, sf_dir)
    newest = raw.agg(F.max("ts_utc").cast("date").alias("d")).first()["d"]
    return E.incremental_extract(raw, since_days=SINCE_DAYS, today=newest).select(*EXTRACT_COLS)


@register("incremental_extract_top_n", EXTRACT_SQL + f"ORDER BY ts_utc DESC, measurement_sk DESC LIMIT {TOP_N}")
def incremental_extract_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest ``TOP_N`` rows of the extract (op B14); the top-N is the feature."""
    return E.incremental_extract(dt.readings(spark, sf_dir), limit=TOP_N).select(*EXTRACT_COLS)
