"""Registered lookups, checks, validation and point projection (ops I1-I5, G8, B19, A12, A13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import catalogs as CAT
from ..operators import lookup as L
from ..operators import synth as SY
from ..operators import validation as V
from ..operators import upsert as U
from ..session import pin_table, scratch_path
from ..sources import base_csv as B
from ..sources import driver_tables as dt
from ..sources import sinks as S
from .q_catalog import SERIES_PLAN_SQL, WIN, _plan, base, caps_c, stations_c, zones_c, with_base
from .q_state import PENDING_FROM, PENDING_TO, PENDING_SQL
from .registry import register

PAGE_SKIP, PAGE_LIMIT = 100, 100
FETCH_ID = 42
SEARCH = "R#00000012"


@register("list_stations", "SELECT * FROM stations", ["stations"])
def q_list(spark, sf_dir):
    return L.list_all(dt.stations(spark, sf_dir))


@register("page_stations", f"SELECT * FROM stations ORDER BY station_id LIMIT {PAGE_LIMIT} OFFSET {PAGE_SKIP}",
          ["stations"])
def q_page(spark, sf_dir):
    return L.page(dt.stations(spark, sf_dir), "station_id", PAGE_SKIP, PAGE_LIMIT)


@register("fetch_station", f"SELECT * FROM stations WHERE station_id = {FETCH_ID}", ["stations"])
def q_fetch(spark, sf_dir):
    return L.fetch(dt.stations(spark, sf_dir), "station_id", FETCH_ID)


@register("capabilities_of_station", f"""
SELECT DISTINCT station_id, pollutant_id, unit FROM readings WHERE station_id = {FETCH_ID}""", ["readings"])
def q_caps_of(spark, sf_dir):
    caps = dt.readings(spark, sf_dir).select("station_id", "pollutant_id", "unit").distinct()
    return L.fetch(caps, "station_id", FETCH_ID)


@register("search_stations", f"""
SELECT * FROM stations WHERE contains(lower(station_name), lower('{SEARCH}'))""", ["stations"])
def q_search(spark, sf_dir):
    return L.search(dt.stations(spark, sf_dir), "station_name", SEARCH)


ORPHAN_SQL = """
SELECT 'stations' AS "table", 'zone_id' AS key, count(*) AS orphans FROM stations
  WHERE zone_id IS NOT NULL AND zone_id NOT IN (SELECT zone_id FROM zones WHERE zone_id IS NOT NULL)
UNION ALL SELECT 'readings', 'station_id', count(*) FROM readings
  WHERE station_id IS NOT NULL AND station_id NOT IN (SELECT station_id FROM stations WHERE station_id IS NOT NULL)
UNION ALL SELECT 'readings', 'pollutant_id', count(*) FROM readings
  WHERE pollutant_id IS NOT NULL AND pollutant_id NOT IN (SELECT pollutant_id FROM pollutants WHERE pollutant_id IS NOT NULL)
UNION ALL SELECT 'measurements', 'station_id', count(*) FROM measurements
  WHERE station_id IS NOT NULL AND station_id NOT IN (SELECT station_id FROM suppliers WHERE station_id IS NOT NULL)
UNION ALL SELECT 'measurements', 'pollutant_id', count(*) FROM measurements
  WHERE pollutant_id IS NOT NULL AND pollutant_id NOT IN (SELECT pollutant_id FROM pollutants WHERE pollutant_id IS NOT NULL)"""


@register("orphan_check", ORPHAN_SQL, ["measurements", "readings", "stations", "suppliers", "zones", "pollutants"])
def q_orphans(spark, sf_dir):
    st, r, m = dt.stations(spark, sf_dir), dt.readings(spark, sf_dir), dt.measurements(spark, sf_dir)
    p, z, sup = dt.pollutants(spark), dt.zones(spark, sf_dir), dt.suppliers(spark, sf_dir)
    return V.orphan_counts([
        ("stations", "zone_id", st, z), ("readings", "station_id", r, st), ("readings", "pollutant_id", r, p),
        ("measurements", "station_id", m, sup), ("measurements", "pollutant_id", m, p)])


def _form_rows(spark, sf_dir):
    """The annual CSV's text fields submitted as measurement forms."""
    c = B.COLS
    return B.driver_base_rows(spark, sf_dir).select(
        F.col(c["station_id"]).alias("station_id"), F.col(c["pollutant"]).alias("pollutant_id"),
        F.concat(F.col(c["year"]), F.lit("-01-01T00:00:00")).alias("ts_utc"),
        F.col(c["value"]).alias("value"), F.col(c["station_type"]).alias("unit"),
        F.col(c["authority"]).alias("source"))


FORM_SQL = with_base("""
WITH f AS (
  SELECT format('{:,}', l.l_suppkey) AS station_id,
         ['PM2.5', 'PM10', 'O3', 'NO2', 'SO2', 'CO', 'Benzene'][l.l_partkey % 7 + 1] AS pollutant_id,
         CAST(year(l.l_shipdate) AS VARCHAR) || '-01-01T00:00:00' AS ts_utc,
         format('{:,}', CAST(l.l_quantity * 1000 + l.l_partkey % 997 AS BIGINT)) AS value,
         CASE WHEN l.l_suppkey % 2 = 0 THEN 'Urbana' ELSE 'Rural' END AS unit,
         'AUTH-' || CAST(s.s_nationkey AS VARCHAR) AS source
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
e AS (
  SELECT *, list_filter([
      CASE WHEN station_id IS NULL OR trim(station_id) = '' THEN 'station_id: required'
           WHEN TRY_CAST(trim(station_id) AS INTEGER) IS NULL THEN 'station_id: not an integer' END,
      CASE WHEN pollutant_id IS NULL OR trim(pollutant_id) = '' THEN 'pollutant_id: required'
           WHEN length(pollutant_id) > 20 THEN 'pollutant_id: longer than 20' END,
      CASE WHEN ts_utc IS NULL OR trim(ts_utc) = '' THEN 'ts_utc: required'
           WHEN TRY_CAST(regexp_replace(trim(ts_utc), '[zZ]$', '') AS TIMESTAMP) IS NULL
           THEN 'ts_utc: not an ISO datetime' END,
      CASE WHEN NOT (value IS NULL OR trim(value) = '') AND TRY_CAST(trim(value) AS DOUBLE) IS NULL
           THEN 'value: not a decimal' END,
      CASE WHEN length(unit) > 20 THEN 'unit: longer than 20' END,
      CASE WHEN length(source) > 50 THEN 'source: longer than 50' END], lambda x: x IS NOT NULL) AS errs
  FROM f)
SELECT station_id, pollutant_id, ts_utc, value, unit, source,
       array_to_string(errs, '; ') AS errors, CAST(len(errs) AS INTEGER) AS n_errors FROM e""")


@register("validate_measurement_forms", FORM_SQL, [])
def q_validate(spark, sf_dir):
    return V.validate(_form_rows(spark, sf_dir), V.measurement_rules())


def _sql_req_len(c: str, n: int) -> str:
    return (f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN '{c}: required' "
            f"WHEN length({c}) > {n} THEN '{c}: longer than {n}' END")


def _sql_int(c: str, required: bool = True) -> str:
    req = f"WHEN {c} IS NULL OR trim({c}) = '' THEN '{c}: required' " if required else ""
    return (f"CASE {req}WHEN NOT ({c} IS NULL OR trim({c}) = '') AND TRY_CAST(trim({c}) AS INTEGER) IS NULL "
            f"THEN '{c}: not an integer' END")


def _sql_dec(c: str) -> str:
    return (f"CASE WHEN NOT ({c} IS NULL OR trim({c}) = '') AND TRY_CAST(trim({c}) AS DOUBLE) IS NULL "
            f"THEN '{c}: not a decimal' END")


def _sql_len(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) > {n} THEN '{c}: longer than {n}' END"


STATION_TEXT = ["station_id", "station_code", "station_name", "zone_id", "lat", "lon", "station_type",
                "authority", "years_min", "years_max"]
_STATION_RULES = ", ".join([
    _sql_int("station_id"), _sql_req_len("station_code", 50), _sql_req_len("station_name", 200),
    _sql_int("zone_id"), _sql_dec("lat"), _sql_dec("lon"), _sql_len("station_type", 100),
    _sql_len("authority", 100), _sql_int("years_min", False), _sql_int("years_max", False)])


@register("validate_station_forms", with_base(f"""
WITH f AS (SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in STATION_TEXT)} FROM stations_c),
e AS (SELECT station_id, list_filter([{_STATION_RULES}], lambda x: x IS NOT NULL) AS errs FROM f)
SELECT CAST(station_id AS INTEGER) AS station_id, array_to_string(errs, '; ') AS errors,
       CAST(len(errs) AS INTEGER) AS n_errors FROM e"""), [])
def q_validate_stations(spark, sf_dir):
    """The derived station catalogue submitted as station forms (B19, station rule
    set): every field as text, checked for presence, type and length."""
    st = stations_c(spark, sf_dir)
    forms = st.select(*[F.col(c).cast("string").alias(c) for c in STATION_TEXT])
    out = V.validate(forms, V.station_rules())
    return out.select(F.col("station_id").cast("int").alias("station_id"), "errors", "n_errors")


@register("influx_points", f"""
WITH p AS ({PENDING_SQL}),
q AS (
  SELECT 'air_quality' AS measurement, CAST(station_id AS VARCHAR) AS station_id, pollutant_id,
         CASE WHEN unit IS NOT NULL AND unit <> '' AND unit <> '0' THEN unit END AS unit,
         CASE WHEN source IS NOT NULL AND source <> '' AND source <> '0' THEN source END AS source,
         CASE WHEN year IS NOT NULL AND CAST(year AS VARCHAR) <> '0' THEN CAST(year AS VARCHAR) END AS year,
         date_trunc('second', ts_utc) AS time, value, measurement_sk
  FROM p)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY measurement, station_id, pollutant_id, unit, source, year, time
                               ORDER BY measurement_sk DESC) AS rn FROM q) WHERE rn = 1""", ["readings"])
def q_points(spark, sf_dir):
    """Pending rows (H6) projected to time-series points."""
    return S.points(U.pending_rows(dt.readings(spark, sf_dir), PENDING_FROM, PENDING_TO))


@register("output_check", with_base(f"""
WITH sp AS ({SERIES_PLAN_SQL}),
counts AS (
  SELECT 'zones' AS "table", count(*) AS n FROM zones_c
  UNION ALL SELECT 'stations', count(*) FROM stations_c
  UNION ALL SELECT 'pollutants', count(*) FROM codes
  UNION ALL SELECT 'station_capabilities', count(*) FROM caps_c
  UNION ALL SELECT 'measurement_years', count(DISTINCT y)
            FROM (SELECT unnest(range(start_year, end_year + 1)) AS y FROM sp))
SELECT "table", CAST(n AS BIGINT) AS n, n > 0 AS ok FROM counts"""), [])
def q_output_check(spark, sf_dir):
    """A whole run of the generator job leaves its catalogues and facts, each derived and written once; then
    what is there is checked from metadata alone (A9, A10, A13)."""
    out = scratch_path(spark, f"outputs-{uuid.uuid4().hex}")

    def left(name, df):
        S.write_table(df, f"{out}/{name}")
        return S.read_table(spark, f"{out}/{name}")

    b = base(spark, sf_dir)
    zones = left("zones", zones_c(spark, sf_dir, b))
    stations = left("stations", stations_c(spark, sf_dir, b, zones))
    left("pollutants", CAT.pollutant_catalogue(spark))
    caps = left("station_capabilities", caps_c(spark, sf_dir, b, stations))
    plan = pin_table(_plan(spark, sf_dir, b, stations, caps), "plan")
    files = S.files_by_year(SY.days_by_year(plan))
    series = SY.daily_series(plan, WIN, SY.generator_partitions(plan), files)
    S.write_facts_by_year(series, f"{out}/measurements", dealt=True)
    return S.output_check(spark, {n: f"{out}/{n}" for n in ("zones", "stations", "pollutants", "station_capabilities")},
                          f"{out}/measurements")
