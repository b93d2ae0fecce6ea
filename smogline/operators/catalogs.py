"""Catalogue derivation from the annual CSV (ops C1-C4, G5, G6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .. import schemas
from ..functions import hashing as H
from ..functions.text import normalize_name, stable_id
from ..session import pin_table
from ..sources.base_csv import COMPACT_N, POS, station_key
from .joins import lookup
from .positions import row_numbers


def pollutant_catalogue(spark: SparkSession) -> DataFrame:
    """The six constants (op C3)."""
    rows = [(code, name, unit, daily, annual) for name, code, unit, daily, annual in K.POLLUTANTS]
    return spark.createDataFrame(rows, schemas.POLLUTANTS)


def variable_codes(spark: SparkSession) -> DataFrame:
    """variable name -> pollutant_id, unit."""
    return spark.createDataFrame([(n, c, u) for n, c, u, _, _ in K.POLLUTANTS],
                                 "variable string, pollutant_id string, unit string")


def zones(base: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Distinct (department, municipality) pairs (op C1).

    zone_id is the number, from 1, of the input row in which the pair first appears
    among the known variables; ids have gaps. Rows are counted over ``rows``, the
    whole input before any filter (by default ``base`` itself, which then must not be
    collapsed). The population and centroid are derived from a hash of the pair, so
    reruns agree."""
    if rows is None:
        if COMPACT_N in base.columns:
            raise ValueError("collapsed rows have no row numbers: give the input rows")
        rows = base
    firsts = pin_table(base.groupBy("dept", "muni").agg(F.min(POS).alias(POS)), "firsts")
    numbered = firsts.join(row_numbers(rows, firsts, POS), POS).withColumnRenamed("row_number", "zone_id")
    dept, muni = normalize_name("dept"), normalize_name("muni")
    zid = F.col("zone_id").cast("int")
    return numbered.select(
        zid.alias("zone_id"),
        stable_id(F.concat_ws("-", dept, muni), length=6, upper=True).alias("city_code"),
        muni.alias("city_name"),
        F.concat(F.lit("Z"), F.when(zid < 10, F.lpad(zid.cast("string"), 2, "0"))
                 .otherwise(zid.cast("string"))).alias("zone_code"),
        F.concat(F.lit("Zona "), muni).alias("zone_name"),
        H.uniform_int(*K.POPULATION_RANGE, "dept", "muni", salt="population").alias("population"),
        F.round(H.uniform(*K.CENTROID_LAT_RANGE, "dept", "muni", salt="lat"), 6).alias("centroid_lat"),
        F.round(H.uniform(*K.CENTROID_LON_RANGE, "dept", "muni", salt="lon"), 6).alias("centroid_lon"),
    )


def zone_by_city(zones_df: DataFrame) -> DataFrame:
    """city_name -> zone_id; on equal names the last zone wins (op G5)."""
    return zones_df.groupBy("city_name").agg(F.max("zone_id").alias("zone_id"))


def stations(base: DataFrame, zones_df: DataFrame, end_year: int, base_data_end: int) -> DataFrame:
    """One row per station id (op C2): first non-null attribute in input order,
    min/max year, years_max lifted to ``end_year`` when it reaches
    ``base_data_end``, zone by normalised municipality (default 1), unparsable
    ids skipped, the first raw id kept per numeric id."""
    def first_nn(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c)) if c in ("lat", "lon")
                                         else F.col(c).isNotNull(), F.col(POS))).alias(c)

    g = base.groupBy("station_raw").agg(
        *[first_nn(c) for c in ("station_name", "dept", "muni", "lat", "lon", "authority", "station_type")],
        F.min("year").cast("int").alias("years_min"), F.max("year").cast("int").alias("years_max"))
    sid_text = station_key("station_raw")
    g = g.withColumn("_sid_text", sid_text).withColumn("station_id", sid_text.try_cast("double").try_cast("int"))
    g = g.filter(F.col("station_id").isNotNull() & F.col("years_min").isNotNull())
    # Keep the first raw id per numeric id (grouped order = raw id text order).
    g = g.groupBy("station_id").agg(F.min_by(F.struct(*[c for c in g.columns if c != "station_id"]),
                                             F.col("station_raw")).alias("_s")).select("station_id", "_s.*")
    g = g.withColumn("city_name", normalize_name("muni"))
    g = lookup(g, zone_by_city(zones_df), "city_name")
    return g.select(
        F.col("station_id").cast("int"),
        F.concat(F.lit("ST-"), F.col("_sid_text")).alias("station_code"),
        normalize_name("station_name").alias("station_name"),
        F.coalesce(F.col("zone_id"), F.lit(1)).cast("int").alias("zone_id"),
        F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"),
        F.col("station_type").cast("string"), F.col("authority").cast("string"),
        F.col("years_min"),
        F.when(F.col("years_max") >= base_data_end, F.lit(end_year)).otherwise(F.col("years_max"))
        .cast("int").alias("years_max"),
    )


def capabilities(spark: SparkSession, base: DataFrame, stations_df: DataFrame,
                 pairs: DataFrame | None = None) -> DataFrame:
    """Distinct (station, pollutant) pairs with a known station and pollutant; the
    unit comes from the catalogue (ops C4, G6). ``pairs`` may give the
    (station_key, pollutant_id) pairs already derived from ``base`` (the keys of
    ``synth.series_sums``), so the raw rows are not scanned again."""
    codes = variable_codes(spark)
    st = stations_df.select(F.regexp_replace("station_code", "^ST-", "").alias("_sid_text"), "station_id")
    if pairs is None:
        pairs = base.select(station_key("station_raw").alias("_sid_text"),
                            F.trim("variable").alias("variable")).distinct()
        # Six literal rows: a fixed size, broadcast without a count.
        pairs = pairs.join(F.broadcast(codes), "variable", "inner")
    else:
        pairs = pairs.select(F.col("station_key").alias("_sid_text"), "pollutant_id").distinct() \
                     .join(F.broadcast(codes.select("pollutant_id", "unit")), "pollutant_id", "inner")
    j = lookup(pairs, st, "_sid_text", how="inner")
    return j.select("station_id", "pollutant_id", "unit").distinct()
