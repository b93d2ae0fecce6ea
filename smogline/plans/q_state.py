"""Registered upserts, incremental state and year bookkeeping (ops H1-H8, A5-A7, I6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import upsert as U
from ..session import scratch_path
from ..sources import driver_tables as dt
from ..sources import sinks as S
from ..sources import years as Y
from .q_analyses import cleaned, cleaned_values, with_clean
from .q_enrich import RUN_LOADED_AT
from .registry import register

STATION_COLS = "station_id, station_code, station_name, zone_id, lat, lon, station_type, authority, years_min, years_max"
RAW_COLS = ["measurement_sk", "station_id", "pollutant_id", "ts_utc", "value", "unit", "source",
            "is_valid", "inserted_at", "processed_at", "year"]
PENDING_FROM, PENDING_TO = "2024-01-01", "2024-01-15"
REQUESTED_YEARS = "1994,1995,1998,2001,2002,2024"
# Scenario: which stored readings are restated (H3) or reprocessed (H2), and
# whose zones are deleted (I6). Data-defined sets; every query reads whole tables.
RESTATED_TYPE, REPROCESSED_TYPE, DELETED_CITY = "purchase", "view", "ASIA"


@register("catalogue_upsert", f"""
SELECT {STATION_COLS} FROM stations WHERE station_id NOT IN (SELECT station_id FROM suppliers)
UNION ALL SELECT {STATION_COLS} FROM suppliers""", ["stations", "suppliers"])
def q_catalogue_upsert(spark, sf_dir):
    """Supplier stations replace the customer stations with the same id (H1)."""
    return U.upsert_replace(dt.stations(spark, sf_dir), dt.suppliers(spark, sf_dir), ["station_id"])


def _restated(spark, sf_dir) -> DataFrame:
    r = dt.readings(spark, sf_dir)
    return (r.filter(F.col("pollutant_id") == RESTATED_TYPE)
            .withColumn("value", F.col("value") * 2).withColumn("source", F.lit("restated")))


@register("delete_insert_by_sk", f"""
SELECT * FROM readings WHERE pollutant_id IS DISTINCT FROM '{RESTATED_TYPE}'
UNION ALL
SELECT measurement_sk, station_id, pollutant_id, ts_utc, value * 2 AS value, unit,
       'restated' AS source, is_valid, inserted_at, processed_at, year
FROM readings WHERE pollutant_id = '{RESTATED_TYPE}'""", ["readings"])
def q_delete_insert(spark, sf_dir):
    """Staged restatements replace their rows by surrogate key (H3)."""
    return U.delete_insert(dt.readings(spark, sf_dir), _restated(spark, sf_dir))


def _shifted_stations(spark, sf_dir) -> DataFrame:
    return dt.suppliers(spark, sf_dir).withColumn("station_id", F.col("station_id") * 20)


_SHIFTED = f"(SELECT station_id * 20 AS station_id, {STATION_COLS.split(', ', 1)[1]} FROM suppliers)"


@register("insert_if_absent_accepted", f"""
SELECT * FROM {_SHIFTED} s WHERE s.station_id NOT IN (SELECT station_id FROM stations)""",
          ["stations", "suppliers"])
def q_insert_accepted(spark, sf_dir):
    return U.insert_if_absent(dt.stations(spark, sf_dir), _shifted_stations(spark, sf_dir), ["station_id"])[0]


@register("insert_if_absent_rejected", f"""
SELECT * FROM {_SHIFTED} s WHERE s.station_id IN (SELECT station_id FROM stations)""",
          ["stations", "suppliers"])
def q_insert_rejected(spark, sf_dir):
    return U.insert_if_absent(dt.stations(spark, sf_dir), _shifted_stations(spark, sf_dir), ["station_id"])[1]


@register("append_rows", """
SELECT * FROM readings UNION ALL
SELECT measurement_sk + 100000000 AS measurement_sk, station_id, pollutant_id, ts_utc, value, unit,
       'appended' AS source, is_valid, inserted_at, processed_at, year
FROM readings WHERE pollutant_id = 'click'""", ["readings"])
def q_append(spark, sf_dir):
    """Append without a key check (H5)."""
    r = dt.readings(spark, sf_dir)
    extra = (r.filter(F.col("pollutant_id") == "click")
             .withColumn("measurement_sk", F.col("measurement_sk") + 100000000)
             .withColumn("source", F.lit("appended")))
    return U.append(r, extra)


UPSERT_SQL = with_clean(f"""
WITH u AS (
  SELECT station_id, pollutant_id, ts_utc, value + 1 AS value, unit, 'reprocessed' AS source
  FROM readings WHERE pollutant_id = '{REPROCESSED_TYPE}'
  UNION ALL SELECT station_id, pollutant_id, ts_utc, value, unit, source FROM clean_m),
old AS (
  SELECT r.measurement_sk, r.station_id, r.pollutant_id, r.ts_utc,
         CASE WHEN u.station_id IS NOT NULL THEN u.value ELSE r.value END AS value,
         CASE WHEN u.station_id IS NOT NULL THEN u.unit ELSE r.unit END AS unit,
         CASE WHEN u.station_id IS NOT NULL THEN u.source ELSE r.source END AS source,
         r.is_valid, r.inserted_at,
         CASE WHEN u.station_id IS NOT NULL THEN NULL ELSE r.processed_at END AS processed_at
  FROM readings r LEFT JOIN u
    ON r.station_id = u.station_id AND r.pollutant_id = u.pollutant_id AND r.ts_utc = u.ts_utc),
new AS (
  SELECT CAST((SELECT coalesce(max(measurement_sk), 0) FROM readings)
              + row_number() OVER (ORDER BY u.station_id, u.pollutant_id, u.ts_utc) AS BIGINT)
           AS measurement_sk,
         u.station_id, u.pollutant_id, u.ts_utc, u.value, u.unit, u.source,
         TRUE AS is_valid, TIMESTAMP '{RUN_LOADED_AT}' AS inserted_at,
         CAST(NULL AS TIMESTAMP) AS processed_at
  FROM u WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.station_id = u.station_id
                           AND r.pollutant_id = u.pollutant_id AND r.ts_utc = u.ts_utc))
SELECT *, CAST(year(ts_utc) AS INTEGER) AS year FROM (SELECT * FROM old UNION ALL SELECT * FROM new)""")


@register("measurement_upsert", UPSERT_SQL, ["measurements", "readings"])
def q_measurement_upsert(spark, sf_dir):
    """Reprocessed readings update in place; cleaned lineitem facts are new rows
    with fresh surrogate keys (H2 + H8)."""
    r = dt.readings(spark, sf_dir)
    upd = (r.filter(F.col("pollutant_id") == REPROCESSED_TYPE)
           .select("station_id", "pollutant_id", "ts_utc", (F.col("value") + 1).alias("value"), "unit",
                   F.lit("reprocessed").alias("source"))
           .unionByName(cleaned(spark, sf_dir).select("station_id", "pollutant_id", "ts_utc", "value",
                                                      "unit", "source")))
    return U.upsert_measurements(r, upd, now=RUN_LOADED_AT).select(*RAW_COLS)


@register("surrogate_keys", with_clean("""
SELECT CAST(row_number() OVER (ORDER BY station_id, pollutant_id, ts_utc) AS BIGINT) AS measurement_sk,
       station_id, pollutant_id, ts_utc, value FROM clean_m"""), ["measurements"])
def q_surrogate_keys(spark, sf_dir):
    df = cleaned_values(spark, sf_dir)
    return U.assign_surrogate_keys(df, ["station_id", "pollutant_id", "ts_utc"], start=0)


PENDING_SQL = f"""
SELECT * FROM readings WHERE processed_at IS NULL AND is_valid
  AND ts_utc BETWEEN TIMESTAMP '{PENDING_FROM}' AND TIMESTAMP '{PENDING_TO}'"""


@register("pending_rows", PENDING_SQL, ["readings"])
def q_pending(spark, sf_dir):
    return U.pending_rows(dt.readings(spark, sf_dir), PENDING_FROM, PENDING_TO)


@register("mark_processed", f"""
SELECT measurement_sk, station_id, pollutant_id, ts_utc, value, unit, source, is_valid, inserted_at,
       CASE WHEN measurement_sk IN (SELECT measurement_sk FROM ({PENDING_SQL}))
            THEN TIMESTAMP '{RUN_LOADED_AT}' ELSE processed_at END AS processed_at, year
FROM readings""", ["readings"])
def q_mark_processed(spark, sf_dir):
    r = dt.readings(spark, sf_dir)
    return U.mark_processed(r, U.pending_rows(r, PENDING_FROM, PENDING_TO), now=RUN_LOADED_AT)


FACT_YEAR_START, FACT_YEAR_END = "1990", "2035"  # job parameters: the whole table


@register("facts_by_year_roundtrip", with_clean("""
SELECT station_id, pollutant_id, ts_utc, value, unit, source, CAST(year(ts_utc) AS INTEGER) AS year
FROM clean_m"""), ["measurements"])
def q_facts_by_year(spark, sf_dir):
    """Cleaned facts written as one dataset partitioned by year (A9), then read
    back for the years of an inclusive YEAR_START..YEAR_END selection (A5) as a
    partition filter (A4)."""
    path = scratch_path(spark, f"facts-{uuid.uuid4().hex}")
    S.write_facts_by_year(cleaned(spark, sf_dir).withColumn("year", cal.year_of("ts_utc")), path)
    years = Y.years_to_process(year="NONE", year_start=FACT_YEAR_START, year_end=FACT_YEAR_END)
    return Y.read_years(spark, path, years)


def _requested(spark):
    return Y.requested_years(spark, Y.years_to_process(years=REQUESTED_YEARS))


_REQ_SQL = "(SELECT CAST(unnest([" + REQUESTED_YEARS + "]) AS INTEGER) AS year)"


@register("years_not_loaded", f"""
SELECT year FROM {_REQ_SQL} q
WHERE year NOT IN (SELECT DISTINCT CAST(year(ts_utc) AS INTEGER) FROM readings)""", ["readings"])
def q_years_not_loaded(spark, sf_dir):
    return Y.years_not_loaded(_requested(spark), dt.readings(spark, sf_dir))


@register("year_status", f"""
SELECT year, CASE WHEN year IN (SELECT DISTINCT CAST(year(ts_utc) AS INTEGER) FROM readings) THEN 'skipped'
                  WHEN year NOT IN (SELECT DISTINCT CAST(year(ts_utc) AS INTEGER) FROM measurements)
                  THEN 'failed' ELSE 'success' END AS status
FROM {_REQ_SQL} q""", ["measurements", "readings"])
def q_year_status(spark, sf_dir):
    return Y.year_status(_requested(spark), dt.measurements(spark, sf_dir), dt.readings(spark, sf_dir))


_GONE_ZONES = f"(SELECT zone_id FROM zones WHERE city_name = '{DELETED_CITY}')"
_GONE_STATIONS = f"(SELECT station_id FROM stations WHERE zone_id IN {_GONE_ZONES})"


def _cascade(spark, sf_dir) -> dict[str, DataFrame]:
    """Deleting the zones of one city removes its stations, their capabilities and readings."""
    z = dt.zones(spark, sf_dir)
    r = dt.readings(spark, sf_dir)
    caps = r.select("station_id", "pollutant_id", "unit").distinct()
    return U.cascade_delete_zones(z, dt.stations(spark, sf_dir), caps, r,
                                  z.filter(F.col("city_name") == DELETED_CITY))


@register("cascade_delete_readings", f"SELECT * FROM readings WHERE station_id NOT IN {_GONE_STATIONS}",
          ["readings", "stations", "zones"])
def q_cascade(spark, sf_dir):
    return _cascade(spark, sf_dir)["measurements_raw"]


@register("cascade_delete_zones", f"SELECT * FROM zones WHERE zone_id NOT IN {_GONE_ZONES}", ["zones"])
def q_cascade_zones(spark, sf_dir):
    return _cascade(spark, sf_dir)["zones"]


@register("cascade_delete_stations", f"""
SELECT * FROM stations WHERE zone_id IS NULL OR zone_id NOT IN {_GONE_ZONES}""", ["stations", "zones"])
def q_cascade_stations(spark, sf_dir):
    return _cascade(spark, sf_dir)["stations"]


@register("cascade_delete_capabilities", f"""
SELECT DISTINCT station_id, pollutant_id, unit FROM readings WHERE station_id NOT IN {_GONE_STATIONS}""",
          ["readings", "stations", "zones"])
def q_cascade_capabilities(spark, sf_dir):
    return _cascade(spark, sf_dir)["station_capabilities"]
