"""Registered form rules over submitted rows with every kind of defect (op B19), and small sources and
rules that had tests only (ops A3, B20, B21)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas
from ..operators import cleaning as C
from ..operators import validation as V
from ..session import scratch_path
from ..sources import driver_tables as dt
from ..sources import sinks as S
from .q_misc import _sql_dec, _sql_len, _sql_req_len
from .registry import register

# Forms as text; each expression reads the same in Spark and DuckDB. Defects come from the rows' numbers.
ZONE_FORM = {
    "zone_id": "CASE WHEN station_id % 11 = 0 THEN '' WHEN station_id % 13 = 0 THEN 'Z9' ELSE CAST(station_id AS STRING) END",
    "city_code": "CASE WHEN station_id % 7 = 0 THEN station_name ELSE station_code END",
    "city_name": "CASE WHEN station_id % 17 = 0 THEN '  ' ELSE station_name END",
    "zone_code": "CASE WHEN station_id % 5 = 0 THEN repeat(station_code, 12) ELSE station_code END",
    "zone_name": "station_type",
    "population": "CASE WHEN station_id % 3 = 0 THEN '12.5' WHEN station_id % 3 = 1 THEN NULL ELSE CAST(years_min AS STRING) END",
    "centroid_lat": "CASE WHEN station_id % 4 = 0 THEN 'north' ELSE CAST(zone_id AS STRING) END",
    "centroid_lon": "CASE WHEN station_id % 6 = 0 THEN '' ELSE '-74.5' END"}
POLLUTANT_FORM = {
    "pollutant_id": "CASE WHEN station_id % 9 = 0 THEN station_name || station_code ELSE station_code END",
    "name": "CASE WHEN station_id % 8 = 0 THEN NULL WHEN station_id % 5 = 0 THEN repeat(station_name, 6) ELSE station_name END",
    "default_unit": "CASE WHEN station_id % 10 = 0 THEN repeat(station_type, 3) ELSE station_type END",
    "who_daily_limit": "CASE WHEN station_id % 4 = 0 THEN 'high' ELSE CAST(years_min AS STRING) END",
    "who_annual_limit": "CASE WHEN station_id % 6 = 0 THEN '' ELSE '1e3' END"}
CAPABILITY_FORM = {
    "station_id": "CASE WHEN measurement_sk % 19 = 0 THEN 'ST-1' ELSE CAST(station_id AS STRING) END",
    "pollutant_id": "CASE WHEN measurement_sk % 23 = 0 THEN repeat(pollutant_id, 9) WHEN measurement_sk % 29 = 0 THEN '' ELSE pollutant_id END",
    "unit": "CASE WHEN measurement_sk % 31 = 0 THEN repeat('ug/m3', 5) ELSE unit END"}
MEASUREMENT_FORM = {
    "station_id": "CAST(station_id AS STRING)", "pollutant_id": "pollutant_id",
    "ts_utc": "CASE WHEN measurement_sk % 5 = 0 THEN 'yesterday' ELSE CAST(year AS STRING) || '-01-31T10:00:00' END",
    "value": "CASE WHEN measurement_sk % 3 = 0 THEN '1,5' ELSE '1.5' END", "unit": "unit", "source": "source",
    "is_valid": "CASE measurement_sk % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN 'valid' WHEN 3 THEN '' "
                "WHEN 4 THEN '2' ELSE ' On ' END"}

_IS_BOOL = ("CASE WHEN NOT (is_valid IS NULL OR trim(is_valid) = '') AND lower(trim(is_valid)) NOT IN ("
            + ", ".join(f"'{t}'" for t in V.BOOLEAN_TEXTS) + ") THEN 'is_valid: not a boolean' END")
_IS_TIME = ("CASE WHEN ts_utc IS NULL OR trim(ts_utc) = '' THEN 'ts_utc: required' "
            "WHEN TRY_CAST(regexp_replace(trim(ts_utc), '[zZ]$', '') AS TIMESTAMP) IS NULL THEN 'ts_utc: not an ISO datetime' END")


def _sql_int(c: str, required: bool = True) -> str:
    """DuckDB rounds '12.5' to a whole number; a form does not take it."""
    missing = f"WHEN {c} IS NULL OR trim({c}) = '' THEN '{c}: required' " if required else ""
    return (f"CASE {missing}WHEN trim({c}) <> '' AND (NOT regexp_full_match(trim({c}), '[+-]?[0-9]+') "
            f"OR TRY_CAST(trim({c}) AS INTEGER) IS NULL) THEN '{c}: not an integer' END")


def _form_sql(view: str, key: str, form: dict[str, str], rules: list[str]) -> str:
    cols = ", ".join(f"{sql.replace(' AS STRING)', ' AS VARCHAR)')} AS {c}" for c, sql in form.items())
    return f"""
WITH f AS (SELECT {key} AS form_id, {cols} FROM {view}),
e AS (SELECT *, list_filter([{", ".join(rules)}], lambda x: x IS NOT NULL) AS errs FROM f)
SELECT * EXCLUDE (errs), array_to_string(errs, '; ') AS errors, CAST(len(errs) AS INTEGER) AS n_errors FROM e"""


def _forms(df, key: str, form: dict[str, str]):
    return df.select(F.col(key).alias("form_id"), *(F.expr(sql).alias(c) for c, sql in form.items()))


@register("validate_zone_forms", _form_sql("stations", "station_id", ZONE_FORM, [
    _sql_int("zone_id"), _sql_req_len("city_code", 10), _sql_req_len("city_name", 100), _sql_len("zone_code", 50),
    _sql_len("zone_name", 100), _sql_int("population", False), _sql_dec("centroid_lat"), _sql_dec("centroid_lon")]), ["stations"])
def q_zone_forms(spark, sf_dir):
    return V.validate(_forms(dt.stations(spark, sf_dir), "station_id", ZONE_FORM), V.zone_rules())


@register("validate_pollutant_forms", _form_sql("stations", "station_id", POLLUTANT_FORM, [
    _sql_req_len("pollutant_id", 20), _sql_req_len("name", 100), _sql_len("default_unit", 20),
    _sql_dec("who_daily_limit"), _sql_dec("who_annual_limit")]), ["stations"])
def q_pollutant_forms(spark, sf_dir):
    return V.validate(_forms(dt.stations(spark, sf_dir), "station_id", POLLUTANT_FORM), V.pollutant_rules())


@register("validate_capability_forms", _form_sql("readings", "measurement_sk", CAPABILITY_FORM, [
    _sql_int("station_id"), _sql_req_len("pollutant_id", 20), _sql_len("unit", 20)]), ["readings"])
def q_capability_forms(spark, sf_dir):
    return V.validate(_forms(dt.readings(spark, sf_dir), "measurement_sk", CAPABILITY_FORM), V.capability_rules())


@register("validate_flagged_measurements", _form_sql("readings", "measurement_sk", MEASUREMENT_FORM, [
    _sql_int("station_id"), _sql_req_len("pollutant_id", 20), _IS_TIME, _sql_dec("value"), _sql_len("unit", 20),
    _sql_len("source", 50), _IS_BOOL]), ["readings"])
def q_flagged_measurements(spark, sf_dir):
    """Measurement forms with the validity flag, which takes the usual texts of true and false."""
    forms = _forms(dt.readings(spark, sf_dir), "measurement_sk", MEASUREMENT_FORM)
    return V.validate(forms, V.measurement_rules(flagged=True))


@register("valid_capability_forms", _form_sql("readings", "measurement_sk", CAPABILITY_FORM, [
    _sql_int("station_id"), _sql_req_len("pollutant_id", 20), _sql_len("unit", 20)]) + " WHERE len(errs) = 0", ["readings"])
def q_valid_capability_forms(spark, sf_dir):
    return V.split_valid(q_capability_forms(spark, sf_dir))[0]


@register("catalogue_source", "SELECT * FROM stations", ["stations"])
def q_catalogue_source(spark, sf_dir):
    """A catalogue read with its declared schema and required columns."""
    path = scratch_path(spark, f"stations-{uuid.uuid4().hex}")
    S.write_table(dt.stations(spark, sf_dir), path)
    return S.read_catalogue(spark, path, schemas.STATIONS)


@register("capabilities_keep_first", """
SELECT station_id, pollutant_id, unit, source FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, pollutant_id ORDER BY ts_utc, measurement_sk) AS rn FROM readings)
WHERE rn = 1""", ["readings"])
def q_capabilities_keep_first(spark, sf_dir):
    """Of several rows of one (station, pollutant) the first is kept (B21); a null key fails the run."""
    r = dt.readings(spark, sf_dir).select("station_id", "pollutant_id", "unit", "source", "ts_utc", "measurement_sk")
    first = C.keep_one(C.fail_on_null_key(r), ["station_id", "pollutant_id"], ["ts_utc", "measurement_sk"], last=False)
    return first.select("station_id", "pollutant_id", "unit", "source")
