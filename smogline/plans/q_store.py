"""Registered runs of the fact store and of versioned tables (ops H1-H3, H7, H8, A6, A10, A11, E6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import cleaning as C
from ..operators import upsert as U
from ..session import scratch_path
from ..sources import driver_tables as dt
from ..sources import sinks as S
from ..sources import years as Y
from ..sources.fact_store import FactStore
from ..streaming.export import export_points, read_points
from .q_analyses import cleaned, with_clean
from .q_enrich import RUN_LOADED_AT
from .q_state import RAW_COLS, RESTATED_TYPE, STATION_COLS
from .registry import register

# Scenario: the cleaned facts are loaded; later a pollutant is restated twice for an older year, and another's
# values of that year arrive again for a year that the store lacks. Buckets of few rows, so that years have several.
RESTATED_YEAR, LATER = 1996, 40
ROWS_PER_BUCKET = 20_000
MARKED_FROM, MARKED_TO = "1997-03-01", "1998-02-01"

LOADED_CTE = f"""
loaded AS (
  SELECT measurement_sk, station_id, pollutant_id, ts_utc, value, unit, source, TRUE AS is_valid,
         TIMESTAMP '{RUN_LOADED_AT}' AS inserted_at,
         CASE WHEN measurement_sk % 2 = 0 THEN TIMESTAMP '{RUN_LOADED_AT}' END AS processed_at,
         CAST(year(ts_utc) AS INTEGER) AS year
  FROM (SELECT *, CAST(row_number() OVER (ORDER BY station_id, pollutant_id, ts_utc) AS BIGINT) AS measurement_sk
        FROM clean_m))"""
UPSERTED_CTE = f"""{LOADED_CTE},
u AS (
  SELECT station_id, pollutant_id, ts_utc, value + 2 AS value, unit, 'restated' AS source
  FROM clean_m WHERE pollutant_id = 'A' AND year(ts_utc) = {RESTATED_YEAR}
  UNION ALL
  SELECT station_id, pollutant_id, ts_utc + INTERVAL {LATER} YEAR, value, unit, 'late'
  FROM clean_m WHERE pollutant_id = 'R' AND year(ts_utc) = {RESTATED_YEAR}),
after AS (
  SELECT s.measurement_sk, s.station_id, s.pollutant_id, s.ts_utc, coalesce(u.value, s.value) AS value,
         coalesce(u.unit, s.unit) AS unit, coalesce(u.source, s.source) AS source, s.is_valid, s.inserted_at,
         CASE WHEN u.station_id IS NULL THEN s.processed_at END AS processed_at, s.year
  FROM loaded s LEFT JOIN u USING (station_id, pollutant_id, ts_utc)
  UNION ALL
  SELECT CAST((SELECT max(measurement_sk) FROM loaded)
              + row_number() OVER (ORDER BY station_id, pollutant_id, ts_utc) AS BIGINT),
         station_id, pollutant_id, ts_utc, value, unit, source, TRUE, TIMESTAMP '2030-01-01',
         NULL, CAST(year(ts_utc) AS INTEGER)
  FROM u WHERE source = 'late')"""


def loaded_store(spark, sf_dir) -> FactStore:
    """A store of the cleaned facts, numbered in key order; every other row was exported before."""
    rows = U.assign_surrogate_keys(cleaned(spark, sf_dir), C.NATURAL_KEY)
    at = F.lit(RUN_LOADED_AT).cast("timestamp_ntz")
    rows = rows.select(
        "measurement_sk", *C.NATURAL_KEY, "value", "unit", "source", F.lit(True).alias("is_valid"), at.alias("inserted_at"),
        F.when(F.col("measurement_sk") % 2 == 0, at).alias("processed_at"))
    return FactStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex}"), rows_per_bucket=ROWS_PER_BUCKET).create(rows)


def later_updates(spark, sf_dir) -> DataFrame:
    year = cleaned(spark, sf_dir).filter(cal.year_of("ts_utc") == RESTATED_YEAR)
    again = year.filter(F.col("pollutant_id") == "A").withColumn("source", F.lit("restated"))
    new = year.filter(F.col("pollutant_id") == "R").withColumn("source", F.lit("late")) \
        .withColumn("ts_utc", F.expr(f"ts_utc + INTERVAL {LATER} YEAR"))
    return (again.withColumn("value", F.col("value") + 1).withColumn("turn", F.lit(1))
            .unionByName(again.withColumn("value", F.col("value") + 2).withColumn("turn", F.lit(2)))
            .unionByName(new.withColumn("turn", F.lit(1))))


def upserted_store(spark, sf_dir) -> FactStore:
    store = loaded_store(spark, sf_dir)
    store.upsert(later_updates(spark, sf_dir), now="2030-01-01 00:00:00", order=["turn"])
    return store


@register("store_upsert", with_clean(f"WITH {UPSERTED_CTE.strip()}\nSELECT * FROM after"), ["measurements"])
def q_store_upsert(spark, sf_dir):
    """An update of an older year, each key given twice, and a new year (H2, H8)."""
    return upserted_store(spark, sf_dir).read().select(*RAW_COLS)


@register("store_years", with_clean(f"""WITH {UPSERTED_CTE.strip()}
SELECT year, count(*) AS n_rows, year IN ({RESTATED_YEAR}, {RESTATED_YEAR + LATER}) AS rewritten
FROM after GROUP BY year"""), ["measurements"])
def q_store_years(spark, sf_dir):
    """Rows by year and whether the upsert wrote the year, from the store's manifest alone."""
    store = loaded_store(spark, sf_dir)
    before = store.years().select("year", F.col("v").alias("was"))
    store.upsert(later_updates(spark, sf_dir), now="2030-01-01 00:00:00", order=["turn"])
    # years: bounded by the calendar
    return store.years().join(F.broadcast(before), "year", "left").select("year", "n_rows", (~F.col("v").eqNullSafe(F.col("was"))).alias("rewritten"))


@register("store_years_not_loaded", with_clean("""
SELECT CAST(y AS INTEGER) AS year FROM (SELECT unnest(range(1990, 2036)) AS y)
WHERE y NOT IN (SELECT year(ts_utc) FROM clean_m)"""), ["measurements"])
def q_store_not_loaded(spark, sf_dir):
    """Requested years that the store lacks, from its manifest."""
    requested = Y.requested_years(spark, Y.years_to_process(year_start="1990", year_end="2035"))
    return Y.years_not_loaded(requested, loaded_store(spark, sf_dir).years())


@register("store_mark_processed", with_clean(f"""WITH {LOADED_CTE.strip()}
SELECT * EXCLUDE (processed_at),
       CASE WHEN processed_at IS NULL AND is_valid
                 AND ts_utc BETWEEN TIMESTAMP '{MARKED_FROM}' AND TIMESTAMP '{MARKED_TO}'
            THEN TIMESTAMP '2030-01-01' ELSE processed_at END AS processed_at
FROM loaded"""), ["measurements"])
def q_store_mark(spark, sf_dir):
    """Pending rows of a range are marked in the years that hold them (H6, H7)."""
    store = loaded_store(spark, sf_dir)
    store.mark_processed(U.pending_rows(store.read(), MARKED_FROM, MARKED_TO), now="2030-01-01 00:00:00")
    return store.read().select(*RAW_COLS)


@register("staging_to_live", f"""
SELECT * FROM readings WHERE pollutant_id IS DISTINCT FROM '{RESTATED_TYPE}'
UNION ALL
SELECT measurement_sk, station_id, pollutant_id, ts_utc + INTERVAL 1 YEAR AS ts_utc, value * 2 AS value, unit,
       'restated' AS source, is_valid, inserted_at, processed_at, CAST(year(ts_utc + INTERVAL 1 YEAR) AS INTEGER) AS year
FROM readings WHERE pollutant_id = '{RESTATED_TYPE}'""", ["readings"])
def q_staging_to_live(spark, sf_dir):
    """Restated rows, which move to another year, are staged, then replace their rows by
    surrogate key in a store kept by it (A11, H3)."""
    r = dt.readings(spark, sf_dir)
    staging = scratch_path(spark, f"staging-{uuid.uuid4().hex}")
    S.write_table(r.filter(F.col("pollutant_id") == RESTATED_TYPE)
                  .withColumn("ts_utc", F.expr("ts_utc + INTERVAL 1 YEAR")).withColumn("year", cal.year_of("ts_utc"))
                  .withColumn("value", F.col("value") * 2).withColumn("source", F.lit("restated")), staging)
    store = FactStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex}"), keys=["measurement_sk"],
                      rows_per_bucket=ROWS_PER_BUCKET).create(r)
    store.replace(S.read_table(spark, staging))
    return store.read().select(*RAW_COLS)


@register("catalogue_republished", f"""
SELECT {STATION_COLS} FROM stations WHERE station_id NOT IN (SELECT station_id FROM suppliers)
UNION ALL SELECT {STATION_COLS} FROM suppliers""", ["stations", "suppliers"])
def q_catalogue_republished(spark, sf_dir):
    """A catalogue is loaded, upserted from its own live rows and replaced (A10, H1)."""
    path = scratch_path(spark, f"stations-{uuid.uuid4().hex}")
    S.write_table(dt.stations(spark, sf_dir), path)
    S.write_table(U.upsert_replace(S.read_table(spark, path), dt.suppliers(spark, sf_dir), ["station_id"]), path)
    return S.read_table(spark, path)


@register("stream_points", """
WITH src AS (
  SELECT measurement_sk, station_id, pollutant_id, ts_utc, value, unit, source, year FROM readings
  WHERE processed_at IS NULL AND is_valid
  UNION ALL
  SELECT measurement_sk + 100000000, station_id, pollutant_id, ts_utc - INTERVAL 1 YEAR, value + 5, unit, source,
         CAST(year(ts_utc - INTERVAL 1 YEAR) AS INTEGER) FROM readings WHERE processed_at IS NULL AND is_valid),
p AS (
  SELECT 'air_quality' AS measurement, CAST(station_id AS VARCHAR) AS station_id, pollutant_id,
         nullif(unit, '') AS unit, nullif(source, '') AS source, CAST(year AS VARCHAR) AS year,
         date_trunc('second', ts_utc) AS time, value, measurement_sk FROM src)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY measurement, station_id, pollutant_id, unit, source, year, time
                               ORDER BY measurement_sk DESC) AS rn FROM p) WHERE rn = 1""", ["readings"])
def q_stream_points(spark, sf_dir):
    """The export stream over a year-partitioned store, run twice with one year rewritten
    between, and the points as the time-series store would hold them (H6, H7, A12)."""
    work = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    facts, out, log = f"{work}/facts", f"{work}/points", f"{work}/checkpoint"
    r = dt.readings(spark, sf_dir)
    before = r.withColumn("ts_utc", F.expr("ts_utc - INTERVAL 1 YEAR")).withColumn("year", cal.year_of("ts_utc")) \
        .withColumn("measurement_sk", F.col("measurement_sk") + 100000000)
    S.write_facts_by_year(r.unionByName(before), facts)
    schema = spark.read.parquet(facts).schema
    export_points(spark, facts, schema, out, log).awaitTermination()
    S.write_facts_by_year(before.withColumn("value", F.col("value") + 5), facts)
    export_points(spark, facts, schema, out, log).awaitTermination()
    return read_points(spark, out)
