"""Registered analyses over the cleaned measurement fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import stats as S
from ..operators import timeseries as TS
from ..sources import driver_tables as dt
from .registry import ORACLES, QUERIES, register

ORDER = ["ingest_batch", "ingest_row"]
M_VIEWS = ["measurements"]

# Cleaned measurements: rules B5-B8, then the last row per natural key.
CLEAN_CTE = """
clean_m AS (
  SELECT station_id, pollutant_id, ts_utc, value, unit, source FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, pollutant_id, ts_utc
                                 ORDER BY ingest_batch DESC, ingest_row DESC) AS rn
    FROM measurements
    WHERE station_id IS NOT NULL AND pollutant_id IS NOT NULL AND ts_utc IS NOT NULL
      AND value IS NOT NULL AND NOT isnan(value) AND value >= 0 AND NOT isinf(value)
  ) WHERE rn = 1)"""


def with_clean(sql: str) -> str:
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {CLEAN_CTE.strip()},\n{body[5:]}"
    return f"WITH {CLEAN_CTE.strip()}\n{body}"


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_measurements(dt.measurements(spark, sf_dir), ORDER)


def cleaned_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value alone, which is all that the analyses read: deduplicated by a hash aggregate."""
    return C.clean_measurements(dt.measurements(spark, sf_dir).select(*C.NATURAL_KEY, "value", *ORDER), ORDER)


@register("clean_measurements", with_clean("SELECT * FROM clean_m"), M_VIEWS)
def q_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("cleaning_report", with_clean("""
WITH t AS (
  SELECT *, CASE WHEN station_id IS NULL OR pollutant_id IS NULL OR ts_utc IS NULL
                      OR value IS NULL OR isnan(value) THEN 'null'
                 WHEN value < 0 THEN 'negative'
                 WHEN isinf(value) THEN 'non_finite' END AS reject
  FROM measurements)
SELECT CAST(count(*) AS BIGINT) AS initial_count,
       CAST(count(*) FILTER (WHERE reject = 'null') AS BIGINT) AS nulls_removed,
       CAST(count(*) FILTER (WHERE reject = 'negative') AS BIGINT) AS negative_values,
       CAST(count(*) FILTER (WHERE reject = 'non_finite') AS BIGINT) AS non_finite_values,
       CAST(0 AS BIGINT) AS invalid_timestamps,
       CAST(count_if(reject IS NULL) - (SELECT count(*) FROM clean_m) AS BIGINT) AS duplicates_removed,
       CAST((SELECT count(*) FROM clean_m) AS BIGINT) AS final_count,
       round((count(*) - (SELECT count(*) FROM clean_m)) * 100.0 / count(*), 2) AS removed_pct
FROM t"""), M_VIEWS)
def q_cleaning_report(spark, sf_dir):
    return C.cleaning_report(dt.measurements(spark, sf_dir))


def _yearly(mode):
    year = ("CAST(year(ts_utc) AS INTEGER)" if mode == "calendar"
            else "CAST(floor(epoch(ts_utc) / 31536000) + 1970 AS INTEGER)")
    return with_clean(f"""
SELECT {year} AS year, pollutant_id, CAST(station_id AS VARCHAR) AS station_id,
       min(value) AS min_value, max(value) AS max_value, avg(value) AS avg_value,
       count(*) AS count_records
FROM clean_m GROUP BY 1, 2, 3""")


@register("yearly_stats", _yearly("calendar"), M_VIEWS)
def q_yearly(spark, sf_dir):
    return TS.yearly_stats(cleaned_values(spark, sf_dir))


@register("yearly_stats_epoch365", _yearly("epoch365"), M_VIEWS)
def q_yearly_epoch(spark, sf_dir):
    return TS.yearly_stats(cleaned_values(spark, sf_dir), year_mode="epoch365")


PEAKS_SQL = with_clean("""
SELECT year, pollutant_id, CAST(station_id AS VARCHAR) AS station_id,
       min(ts_utc) FILTER (WHERE value = maxv) AS peak_time, max(maxv) AS peak_value,
       min(ts_utc) FILTER (WHERE value = minv) AS valley_time, max(minv) AS valley_value
FROM (SELECT *, CAST(year(ts_utc) AS INTEGER) AS year,
             max(value) OVER g AS maxv, min(value) OVER g AS minv
      FROM clean_m
      WINDOW g AS (PARTITION BY year(ts_utc), pollutant_id, station_id))
GROUP BY 1, 2, 3""")


@register("peaks_valleys", PEAKS_SQL, M_VIEWS)
def q_peaks(spark, sf_dir):
    return TS.peaks_valleys(cleaned_values(spark, sf_dir))


@register("yearly_profile", with_clean("""
SELECT year, pollutant_id, CAST(station_id AS VARCHAR) AS station_id,
       min(value) AS min_value, max(value) AS max_value, avg(value) AS avg_value,
       count(*) AS count_records,
       min(ts_utc) FILTER (WHERE value = maxv) AS peak_time,
       min(ts_utc) FILTER (WHERE value = minv) AS valley_time
FROM (SELECT *, CAST(year(ts_utc) AS INTEGER) AS year,
             max(value) OVER g AS maxv, min(value) OVER g AS minv
      FROM clean_m
      WINDOW g AS (PARTITION BY year(ts_utc), pollutant_id, station_id))
GROUP BY 1, 2, 3"""), M_VIEWS)
def q_profile(spark, sf_dir):
    return TS.yearly_profile(cleaned_values(spark, sf_dir))


@register("monthly_mean", with_clean("""
SELECT station_id, pollutant_id, date_trunc('month', ts_utc) AS month_start,
       avg(value) AS mean_value
FROM clean_m GROUP BY 1, 2, 3"""), M_VIEWS)
def q_monthly_mean(spark, sf_dir):
    return TS.monthly_mean(cleaned_values(spark, sf_dir))


@register("daily_derivative", with_clean("""
SELECT ts_utc AS time, CAST(year(ts_utc) AS INTEGER) AS year,
       CAST(month(ts_utc) AS INTEGER) AS month, CAST(day(ts_utc) AS INTEGER) AS day,
       pollutant_id, CAST(station_id AS VARCHAR) AS station_id,
       (value - lag(value) OVER w)
         / (CAST(epoch_us(ts_utc) - epoch_us(lag(ts_utc) OVER w) AS DOUBLE) / CAST(86400000000 AS DOUBLE))
         AS daily_rate
FROM clean_m
WINDOW w AS (PARTITION BY station_id, pollutant_id ORDER BY ts_utc)
QUALIFY lag(ts_utc) OVER w IS NOT NULL"""), M_VIEWS)
def q_daily_derivative(spark, sf_dir):
    return TS.daily_derivative(cleaned_values(spark, sf_dir))


@register("monthly_derivative", with_clean("""
WITH mm AS (
  SELECT station_id, pollutant_id, date_trunc('month', ts_utc) AS month_start,
         avg(value) AS mean_value
  FROM clean_m GROUP BY 1, 2, 3),
d AS (
  SELECT station_id, pollutant_id, month_start,
         CAST(month_start + INTERVAL 1 MONTH AS TIMESTAMP) AS time,
         (mean_value - lag(mean_value) OVER w)
           / CAST((year(month_start) * 12 + month(month_start))
                  - lag(year(month_start) * 12 + month(month_start)) OVER w AS DOUBLE) AS monthly_rate
  FROM mm WINDOW w AS (PARTITION BY station_id, pollutant_id ORDER BY month_start))
SELECT time, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
       pollutant_id, CAST(station_id AS VARCHAR) AS station_id, monthly_rate, month_start
FROM d WHERE monthly_rate IS NOT NULL"""), M_VIEWS)
def q_monthly_derivative(spark, sf_dir):
    return TS.monthly_derivative(cleaned_values(spark, sf_dir))


# --- descriptive statistics of the cleaned set (E2-E7, E9) ---------------------

@register("describe_by_pollutant", with_clean("""
SELECT pollutant_id, count(value) AS count, round(avg(value), 2) AS mean,
       round(min(value), 2) AS min, round(max(value), 2) AS max,
       round(stddev_samp(value), 2) AS std
FROM clean_m GROUP BY 1"""), M_VIEWS)
def q_describe(spark, sf_dir):
    return S.describe_by_pollutant(cleaned_values(spark, sf_dir))


@register("time_span", with_clean("""
SELECT min(ts_utc) AS first_ts, max(ts_utc) AS last_ts,
       CAST(date_sub('day', min(ts_utc), max(ts_utc)) AS BIGINT) AS days
FROM clean_m"""), M_VIEWS)
def q_time_span(spark, sf_dir):
    return S.time_span(cleaned_values(spark, sf_dir))


@register("distinct_stations", with_clean(
    "SELECT count(DISTINCT station_id) AS unique_stations FROM clean_m"), M_VIEWS)
def q_distinct_stations(spark, sf_dir):
    return S.distinct_stations(cleaned_values(spark, sf_dir))


@register("top_stations", with_clean("""
SELECT station_id, count(*) AS n_measurements FROM clean_m
GROUP BY 1 ORDER BY n_measurements DESC, station_id ASC LIMIT 5"""), M_VIEWS)
def q_top_stations(spark, sf_dir):
    return S.top_stations(cleaned_values(spark, sf_dir), 5)


@register("rows_per_year", with_clean("""
SELECT CAST(year(ts_utc) AS INTEGER) AS year, count(*) AS n_rows FROM clean_m GROUP BY 1"""), M_VIEWS)
def q_rows_per_year(spark, sf_dir):
    return S.rows_per_year(cleaned_values(spark, sf_dir))


@register("base_vs_projected", with_clean(f"""
SELECT count(*) AS total_records,
       CAST(count_if(year(ts_utc) <= {dt.BASE_DATA_END}) AS BIGINT) AS base_records,
       CAST(count_if(year(ts_utc) > {dt.BASE_DATA_END}) AS BIGINT) AS projected_records
FROM clean_m"""), M_VIEWS)
def q_base_vs_projected(spark, sf_dir):
    return S.base_vs_projected(cleaned_values(spark, sf_dir), dt.BASE_DATA_END)


@register("dataset_summary", with_clean("""
SELECT count(*) AS n_rows, CAST(min(year(ts_utc)) AS INTEGER) AS first_year,
       CAST(max(year(ts_utc)) AS INTEGER) AS last_year,
       count(DISTINCT station_id) AS n_stations,
       string_agg(DISTINCT pollutant_id, ',' ORDER BY pollutant_id) AS pollutants
FROM clean_m"""), M_VIEWS)
def q_dataset_summary(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("year", F.year("ts_utc"))
    return S.dataset_summary(df)


# --- a text feed with defects (B5-B11) ------------------------------------------

# What each defect of ``driver_tables.text_measurements`` means, from the numbers that place it.
TEXT_CTE = """
text_t AS (
  SELECT station_id, pollutant_id, value, bad_time,
         CASE defect WHEN 1 THEN l_shipdate - INTERVAL 2 HOUR WHEN 2 THEN l_shipdate + INTERVAL 5 HOUR
                     WHEN 0 THEN NULL WHEN 4 THEN NULL ELSE l_shipdate END AS ts_utc,
         CASE WHEN station_id IS NULL OR pollutant_id IS NULL OR value IS NULL OR defect = 4 THEN 'null'
              WHEN value < 0 THEN 'negative' WHEN isinf(value) THEN 'non_finite'
              WHEN bad_time THEN 'bad_timestamp' END AS reject,
         ingest_batch, ingest_row
  FROM (SELECT CASE WHEN l_partkey % 37 <> 0 THEN CAST(l_suppkey AS INTEGER) END AS station_id,
               l_returnflag AS pollutant_id, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, l_orderkey % 19 AS defect,
               l_orderkey % 19 = 0 AS bad_time,
               CASE l_partkey % 23 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 5 THEN NULL WHEN 2 THEN -l_quantity
                    WHEN 3 THEN CAST('inf' AS DOUBLE) WHEN 4 THEN CAST('-inf' AS DOUBLE)
                    ELSE l_quantity END AS value,
               l_orderkey AS ingest_batch, l_linenumber AS ingest_row FROM lineitem)),
text_clean AS (
  SELECT station_id, pollutant_id, ts_utc, CAST(value AS DOUBLE) AS value FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, pollutant_id, ts_utc
                                 ORDER BY ingest_batch DESC, ingest_row DESC) AS rn
    FROM text_t WHERE reject IS NULL) WHERE rn = 1)"""


@register("clean_text_facts", f"WITH {TEXT_CTE.strip()}\nSELECT * FROM text_clean", [])
def q_clean_text(spark, sf_dir):
    """Text facts through every rule: numbers and times parsed, offsets applied, last row kept."""
    return C.clean_measurements(dt.text_measurements(spark, sf_dir), ORDER, sort_by_time=True)


@register("text_facts_report", f"""WITH {TEXT_CTE.strip()}
SELECT count(*) AS initial_count,
       CAST(count_if(reject = 'null') AS BIGINT) AS nulls_removed,
       CAST(count_if(reject = 'negative') AS BIGINT) AS negative_values,
       CAST(count_if(reject = 'non_finite') AS BIGINT) AS non_finite_values,
       CAST(count_if(reject = 'bad_timestamp') AS BIGINT) AS invalid_timestamps,
       CAST(count_if(reject IS NULL) - (SELECT count(*) FROM text_clean) AS BIGINT) AS duplicates_removed,
       (SELECT count(*) FROM text_clean) AS final_count,
       round((count(*) - (SELECT count(*) FROM text_clean)) * 100.0 / count(*), 2) AS removed_pct
FROM text_t""", [])
def q_text_report(spark, sf_dir):
    return C.cleaning_report(dt.text_measurements(spark, sf_dir))


# --- the analyses over a range that cuts months and years (B22) ------------------

START, STOP = "1996-03-10 00:00:00", "1997-06-15 00:00:00"


def _ranged(name: str, analysis) -> None:
    def query(spark, sf_dir):
        return analysis(cleaned_values(spark, sf_dir), start=START, stop=STOP)

    query.__doc__ = f"``{name}`` over [{START}, {STOP})."
    QUERIES[f"{name}_range"] = query
    ORACLES[f"{name}_range"] = (
        ORACLES[name]
        .replace("NOT isinf(value)", f"NOT isinf(value) AND ts_utc >= TIMESTAMP '{START}' AND ts_utc < TIMESTAMP '{STOP}'")
        .replace("CAST(month_start + INTERVAL 1 MONTH AS TIMESTAMP)",
                 f"least(CAST(month_start + INTERVAL 1 MONTH AS TIMESTAMP), TIMESTAMP '{STOP}')"))


_ranged("yearly_stats", TS.yearly_stats)
_ranged("peaks_valleys", TS.peaks_valleys)
_ranged("daily_derivative", TS.daily_derivative)
_ranged("monthly_derivative", TS.monthly_derivative)
