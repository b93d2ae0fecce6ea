"""Registered catalogue derivation and series generation (ops A1, B1-B4, C1-C4, D1-D14)."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import catalogs as CAT
from ..operators import synth as SY
from ..sources import base_csv as B
from ..session import pin_table, scratch_path
from .registry import register

# Generator parameters of the registered run.
# The base data run from 1995 to 2001; what reaches 2000 is extended to 2002.
WIN = SY.Window_(start_year=1995, end_year=2002, base_data_end=2000, end_date="2002-03-31")

BASE_COLS = ["station_raw", "station_name", "authority", "dept", "muni", "variable", "year", "value",
             "lat", "lon", "station_type"]


def sql_title(x: str) -> str:
    """DuckDB form of the name normalisation (null -> '', trim, accents, title case)."""
    s = f"strip_accents(trim(coalesce({x}, '')))"
    return (f"array_to_string(list_transform(range(1, length({s}) + 1), lambda i: CASE WHEN i = 1 OR NOT "
            f"regexp_matches(substr({s}, i - 1, 1), '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]') THEN upper(substr({s}, i, 1)) "
            f"ELSE lower(substr({s}, i, 1)) END), '')")


def sql_unit(*cols: str, salt: str, part: int = 0) -> str:
    """DuckDB form of the hashed uniform numbers."""
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return (f"((CAST('0x' || substr(md5(concat_ws('|', {texts}, '{salt}')), {1 + 13 * part}, 13) AS BIGINT)"
            f" + 0.5e0) / {float(1 << 52)}e0)")


def sql_uniform(low: float, high: float, *cols: str, salt: str) -> str:
    return f"({float(low)}e0 + {float(high - low)}e0 * {sql_unit(*cols, salt=salt)})"


_VARS = "[" + ", ".join(f"'{v}'" for v in B.VARIABLE_BY_PART) + "]"
_CODES = ("(SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{c}', '{u}')" for n, c, u, _, _ in K.POLLUTANTS)
          + ") AS t(variable, pollutant_id, unit))")

BASE_CTE = f"""
base_all AS (
  SELECT format('{{:,}}', l.l_suppkey) AS station_raw, s.s_name AS station_name,
         'AUTH-' || CAST(s.s_nationkey AS VARCHAR) AS authority, g.r_name AS dept, g.n_name AS muni,
         {_VARS}[l.l_partkey % 7 + 1] AS variable, CAST(year(l.l_shipdate) AS DOUBLE) AS year,
         CAST(l.l_quantity * 1000 + l.l_partkey % 997 AS DOUBLE) AS value, s.s_acctbal / 1000.0 AS lat,
         -66.0 - CAST(s.s_suppkey % 13 AS DOUBLE) AS lon,
         CASE WHEN l.l_suppkey % 2 = 0 THEN 'Urbana' ELSE 'Rural' END AS station_type,
         l.l_orderkey AS p1, l.l_linenumber AS p2, l.l_suppkey AS p3, l.l_partkey AS p4
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) g
    ON s.s_nationkey = g.n_nationkey
  ),
base_t AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY p1, p2, p3, p4) AS row_no FROM base_all)
  WHERE variable IN ({", ".join(f"'{p[0]}'" for p in K.POLLUTANTS)})),
codes AS {_CODES},
zones_c AS (
  SELECT CAST(zone_id AS INTEGER) AS zone_id,
         upper(substr(md5(concat_ws('-', {sql_title('dept')}, {sql_title('muni')})), 1, 6)) AS city_code,
         {sql_title('muni')} AS city_name,
         'Z' || CASE WHEN zone_id < 10 THEN lpad(CAST(zone_id AS VARCHAR), 2, '0')
                     ELSE CAST(zone_id AS VARCHAR) END AS zone_code,
         'Zona ' || {sql_title('muni')} AS zone_name,
         CAST({K.POPULATION_RANGE[0]} + floor({sql_unit('dept', 'muni', salt='population')}
              * {float(K.POPULATION_RANGE[1] - K.POPULATION_RANGE[0])}e0) AS INTEGER) AS population,
         round({sql_uniform(*K.CENTROID_LAT_RANGE, 'dept', 'muni', salt='lat')}, 6) AS centroid_lat,
         round({sql_uniform(*K.CENTROID_LON_RANGE, 'dept', 'muni', salt='lon')}, 6) AS centroid_lon
  FROM (SELECT dept, muni, min(row_no) AS zone_id FROM base_t GROUP BY 1, 2)),
stations_c AS (
  SELECT station_id, 'ST-' || sid AS station_code, {sql_title('station_name')} AS station_name,
         CAST(coalesce(z.zone_id, 1) AS INTEGER) AS zone_id, round(lat, 6) AS lat, round(lon, 6) AS lon,
         station_type, authority, years_min,
         CAST(CASE WHEN years_max >= {WIN.base_data_end} THEN {WIN.end_year} ELSE years_max END AS INTEGER)
           AS years_max
  FROM (
    SELECT *, trim(replace(station_raw, ',', '')) AS sid,
           CAST(TRY_CAST(trim(replace(station_raw, ',', '')) AS DOUBLE) AS INTEGER) AS station_id
    FROM (
      SELECT station_raw,
             arg_min(station_name, row(p1, p2, p3, p4)) FILTER (WHERE station_name IS NOT NULL) AS station_name,
             arg_min(muni, row(p1, p2, p3, p4)) FILTER (WHERE muni IS NOT NULL) AS muni,
             arg_min(lat, row(p1, p2, p3, p4)) FILTER (WHERE lat IS NOT NULL AND NOT isnan(lat)) AS lat,
             arg_min(lon, row(p1, p2, p3, p4)) FILTER (WHERE lon IS NOT NULL AND NOT isnan(lon)) AS lon,
             arg_min(authority, row(p1, p2, p3, p4)) FILTER (WHERE authority IS NOT NULL) AS authority,
             arg_min(station_type, row(p1, p2, p3, p4)) FILTER (WHERE station_type IS NOT NULL) AS station_type,
             CAST(min(year) AS INTEGER) AS years_min, CAST(max(year) AS INTEGER) AS years_max
      FROM base_t GROUP BY station_raw)) st
  LEFT JOIN (SELECT city_name, max(zone_id) AS zone_id FROM zones_c GROUP BY city_name) z
    ON {sql_title('st.muni')} = z.city_name
  WHERE station_id IS NOT NULL AND years_min IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY station_raw) = 1),
caps_c AS (
  SELECT DISTINCT st.station_id, c.pollutant_id, c.unit
  FROM (SELECT DISTINCT trim(replace(station_raw, ',', '')) AS k, trim(variable) AS variable FROM base_t) p
  JOIN (SELECT replace(station_code, 'ST-', '') AS k, station_id FROM stations_c) st ON p.k = st.k
  JOIN codes c ON p.variable = c.variable),
ym AS (
  SELECT trim(replace(station_raw, ',', '')) AS station_key, c.pollutant_id, year, avg(value) AS year_mean
  FROM base_t b JOIN codes c ON trim(b.variable) = c.variable GROUP BY 1, 2, 3),
tr AS (
  SELECT station_key, pollutant_id,
         greatest(least(CASE WHEN avg(year_mean) > 0 THEN regr_slope(year_mean, year) / avg(year_mean)
                             ELSE 0.0 END, {K.TREND_CLIP}), -{K.TREND_CLIP}) AS trend
  FROM ym GROUP BY 1, 2 HAVING count(*) >= 3 AND stddev_pop(year_mean) > 0),
rm AS (
  SELECT trim(replace(station_raw, ',', '')) AS station_key, c.pollutant_id, avg(value) AS annual_mean
  FROM base_t b JOIN codes c ON trim(b.variable) = c.variable GROUP BY 1, 2)"""


def with_base(sql: str) -> str:
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {BASE_CTE.strip()},\n{body[5:]}"
    return f"WITH {BASE_CTE.strip()}\n{body}"


def base(spark, sf_dir, pin: bool = True):
    """Typed CSV rows. With ``pin`` (the catalogue and generator plans), the rows
    are collapsed by ``compact_rows`` and that much smaller table is written
    once to the shared checkpoint folder (a reliable lineage cut) for the
    several aggregates that read it, instead of each re-joining, re-parsing
    and re-grouping the raw rows."""
    b = B.typed_base(B.driver_base_rows(spark, sf_dir))
    return pin_table(B.compact_rows(b), "base_csv") if pin else b


def zones_c(spark, sf_dir, b=None):
    # alone, zones need two columns and the positions of the rows, which are aggregated as they are read
    return CAT.zones(b if b is not None else base(spark, sf_dir, pin=False), B.driver_positions(spark, sf_dir))


def stations_c(spark, sf_dir, b=None, zones=None):
    b = b if b is not None else base(spark, sf_dir)
    return CAT.stations(b, zones if zones is not None else zones_c(spark, sf_dir, b), WIN.end_year, WIN.base_data_end)


def caps_c(spark, sf_dir, b=None, stations=None, sums=None):
    b = b if b is not None else base(spark, sf_dir)
    st = stations if stations is not None else stations_c(spark, sf_dir, b)
    sums = sums if sums is not None else SY.series_sums(b, CAT.variable_codes(spark))
    return CAT.capabilities(spark, b, st, pairs=sums)


@register("base_rows_typed", with_base(f"SELECT {', '.join(BASE_COLS)} FROM base_t"), [])
def q_base(spark, sf_dir):
    """CSV text -> typed rows: separators stripped, six known pollutants (A1, B1, B2)."""
    return base(spark, sf_dir, pin=False).select(*BASE_COLS)


@register("base_csv_roundtrip", with_base(f"SELECT {', '.join(BASE_COLS)} FROM base_t"), [])
def q_base_csv_roundtrip(spark, sf_dir):
    """The annual CSV as real text files: rendered from the driver tables with
    padded header names, written to the shared folder, then read back by the CSV
    source (A1: header, every column as text, trimmed names, required-column
    check B12), parsed (B1) and cut to the six known pollutants (B2)."""
    rows = B.driver_base_rows(spark, sf_dir).drop(B.POS)
    path = scratch_path(spark, f"base_csv_text-{uuid.uuid4().hex}")
    rows.toDF(*[f" {c} " for c in rows.columns]).write.option("header", True).csv(path)
    return B.typed_base(B.read_base_csv(spark, path)).select(*BASE_COLS)


@register("zone_keys", with_base("SELECT zone_id, city_code, city_name, zone_code, zone_name FROM zones_c"), [])
def q_zone_keys(spark, sf_dir):
    """Zones without the hash-derived population and centroid."""
    return zones_c(spark, sf_dir).select("zone_id", "city_code", "city_name", "zone_code", "zone_name")


@register("zones_catalogue", with_base("SELECT * FROM zones_c"), [])
def q_zones(spark, sf_dir):
    """Full zone catalogue, hash-derived population and centroid included."""
    return zones_c(spark, sf_dir)


@register("stations_catalogue", with_base("SELECT * FROM stations_c"), [])
def q_stations(spark, sf_dir):
    """Stations: first non-null attributes, year span, zone by city."""
    return stations_c(spark, sf_dir)


@register("capabilities_catalogue", with_base("SELECT * FROM caps_c"), [])
def q_caps(spark, sf_dir):
    """Known (station, pollutant) pairs with the catalogue unit."""
    return caps_c(spark, sf_dir)


@register("yearly_means", with_base(
    "SELECT station_key, pollutant_id, year, round(year_mean, 6) AS year_mean FROM ym"), [])
def q_yearly_means(spark, sf_dir):
    """Yearly mean per (station, pollutant, year) (D2); rounded for comparison."""
    ym = SY.yearly_means(base(spark, sf_dir, pin=False), CAT.variable_codes(spark))
    return ym.withColumn("year_mean", F.round("year_mean", 6))


@register("trends", with_base("SELECT station_key, pollutant_id, round(trend, 9) AS trend FROM tr"), [])
def q_trends(spark, sf_dir):
    """Clipped relative trend (D3); rounded for comparison."""
    t = SY.trends(SY.yearly_means(base(spark, sf_dir, pin=False), CAT.variable_codes(spark)))
    return t.withColumn("trend", F.round("trend", 9))


def _plan(spark, sf_dir, b=None, stations=None, caps=None):
    """Capabilities, means and trends all come from one (station, pollutant,
    year) aggregate of the base (``series_sums``); Spark reuses its exchange."""
    b = b if b is not None else base(spark, sf_dir)
    sums = SY.series_sums(b, CAT.variable_codes(spark))
    st = stations if stations is not None else stations_c(spark, sf_dir, b)
    caps = caps if caps is not None else CAT.capabilities(spark, b, st, pairs=sums)
    return SY.series_plan(caps, st, SY.raw_means_from(sums), SY.trends(SY.yearly_means_from(sums)), WIN)


SERIES_PLAN_SQL = f"""
SELECT * FROM (
  SELECT c.station_id, c.pollutant_id, c.unit,
         round(coalesce(rm.annual_mean, CASE WHEN c.pollutant_id = 'co' THEN {K.DEFAULT_MEAN_CO}
                                             ELSE {K.DEFAULT_MEAN} END), 6) AS annual_mean,
         round(coalesce(tr.trend, 0.0), 9) AS trend,
         CAST(greatest({WIN.start_year}, s.years_min) AS INTEGER) AS start_year,
         CAST(CASE WHEN s.years_max >= {WIN.base_data_end} THEN {WIN.end_year}
                   ELSE least({WIN.end_year}, s.years_max) END AS INTEGER) AS end_year
  FROM caps_c c JOIN (SELECT station_id, replace(station_code, 'ST-', '') AS station_key, years_min, years_max
                      FROM stations_c) s ON c.station_id = s.station_id
  LEFT JOIN rm ON rm.station_key = s.station_key AND rm.pollutant_id = c.pollutant_id
  LEFT JOIN tr ON tr.station_key = s.station_key AND tr.pollutant_id = c.pollutant_id) x
WHERE make_date(start_year, 1, 1) <= CASE WHEN end_year = {WIN.end_year} THEN DATE '{WIN.end_date}'
                                          ELSE make_date(end_year, 12, 31) END"""


@register("series_plan", with_base(SERIES_PLAN_SQL), [])
def q_series_plan(spark, sf_dir):
    """Per capability: mean with default (D1, D4), trend (D3), window."""
    p = _plan(spark, sf_dir)
    return p.select("station_id", "pollutant_id", "unit", F.round("annual_mean", 6).alias("annual_mean"),
                    F.round("trend", 9).alias("trend"), "start_year", "end_year")


@register("daily_series")
def q_daily_series(spark, sf_dir):
    """The composed generator: capabilities x days -> measurements (D6-D14). Every
    row's value is compared with SQL in ``daily_series_months``."""
    return SY.daily_series(_plan(spark, sf_dir), WIN)


_KEY = ("station_id", "pollutant_id", "d")

DAILY_SQL = f"""
WITH plan AS ({SERIES_PLAN_SQL}),
spans AS (
  SELECT *, make_date(start_year, 1, 1) AS first_day,
         CASE WHEN end_year = {WIN.end_year} THEN DATE '{WIN.end_date}'
              ELSE make_date(end_year, 12, 31) END AS last_day,
         end_year > {WIN.base_data_end} AS is_extended
  FROM plan),
days AS (
  SELECT *, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM spans),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY station_id, pollutant_id ORDER BY {sql_unit(*_KEY, salt='spike')}, d)
              <= floor((date_diff('day', first_day, last_day) + 1) * {K.SPIKE_FRACTION}e0) AS is_spike,
         CASE WHEN is_extended AND trend <> 0
              THEN annual_mean * pow(1e0 + trend, date_diff('day', DATE '{WIN.base_data_end}-12-31', d)
                                                  / {K.DAYS_PER_YEAR}e0)
              ELSE annual_mean END AS adj
  FROM days),
valued AS (
  SELECT *, (adj + {K.NOISE_SD_FRACTION}e0 * adj
                 * (sqrt(-2e0 * ln({sql_unit(*_KEY, salt='noise')}))
                    * cos({2 * math.pi}e0 * {sql_unit(*_KEY, salt='noise', part=1)}))
             + {K.SEASONAL_AMPLITUDE}e0 * annual_mean * sin({2 * math.pi}e0 * dayofyear(d) / {float(K.SEASON_PERIOD)}e0)
             + CASE WHEN pollutant_id IN ({", ".join(f"'{p}'" for p in K.WEEKLY_POLLUTANTS)})
                    THEN CASE WHEN isodow(d) >= 6 THEN {K.WEEKEND_EFFECT}e0 ELSE {K.WEEKDAY_EFFECT}e0 END * adj
                    ELSE 0e0 END)
            * CASE WHEN is_spike THEN {sql_uniform(K.SPIKE_LOW, K.SPIKE_HIGH, *_KEY, salt='spike_size')}
                   ELSE 1e0 END AS v
  FROM drawn),
generated AS (
  SELECT station_id, pollutant_id, unit, d,
         CASE WHEN pollutant_id = 'co' THEN round_even(greatest(v, 0e0), 1)
              ELSE round_even(greatest(v, 0e0), 2) END AS value,
         CASE WHEN year(d) <= {WIN.base_data_end} THEN '{K.SOURCE_BASE}' ELSE '{K.SOURCE_PROJECTED}' END AS source
  FROM valued)
SELECT station_id, pollutant_id, unit, source, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       count(*) AS n_days, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents,
       min(value) AS min_value, max(value) AS max_value,
       CAST(bit_xor(CAST(round(value * 100) AS BIGINT) * day(d)) AS BIGINT) AS day_digest
FROM generated GROUP BY 1, 2, 3, 4, 5, 6"""


@register("daily_series_months", with_base(DAILY_SQL), [])
def q_daily_series_months(spark, sf_dir):
    """The generated series by month (D6-D14): days, exact sum, smallest, largest, and a digest
    that ties each value to its day, so that every generated row counts."""
    cents = F.rint(F.col("value") * 100).cast("long")  # two digits: never a tie
    month, day = F.substring("ts_utc", 6, 2).cast("int"), F.substring("ts_utc", 9, 2).cast("int")
    return (SY.daily_series(_plan(spark, sf_dir), WIN)
            .groupBy("station_id", "pollutant_id", "unit", "source", "year", month.alias("month"))
            .agg(F.count(F.lit(1)).alias("n_days"), F.sum(cents).alias("sum_cents"),
                 F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                 F.bit_xor(cents * day).alias("day_digest")))
