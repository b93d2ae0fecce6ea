"""Air-quality views over the driver's benchmark tables.

The reference reads its catalogues and facts from a relational store; the test
environment ships TPC-H-like parquet instead. These views give the tables the
SQL text for the DuckDB oracle, and the two must stay equal column for column.

    measurements  <- lineitem   (station=l_suppkey, pollutant=l_returnflag,
                                 ts=l_shipdate, value=l_quantity)
    readings      <- events     (sk=event_id, station=user_id, pollutant=event_type)
    stations      <- customer   (stations of ``readings``)
    suppliers     <- supplier   (stations of ``measurements``)
    zones         <- nation + region
    pollutants    <- a literal dimension covering both facts' pollutant keys
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

NAN = float("nan")

# --- fixed values: the pollutant dimension of the driver tables -----------------
# (pollutant_id, name, default_unit, who_daily_limit, who_annual_limit)
# One daily limit is NaN on purpose: it must be read as NULL (op B13).
DRIVER_POLLUTANTS = [
    ("A", "Particulate A", "µg/m³", 45.0, 15.0),
    ("N", "Nitrogen N", "µg/m³", 25.0, 10.0),
    ("R", "Reactive R", "mg/m³", 40.0, None),
    ("click", "Click", "µg/m³", 100.0, 50.0),
    ("view", "View", "µg/m³", 150.0, None),
    ("signup", "Signup", "µg/m³", 200.0, 80.0),
    ("error", "Error", "µg/m³", 300.0, 100.0),
    ("purchase", "Purchase", "µg/m³", NAN, 150.0),
]

BASE_DATA_END = 1998  # last "observed" year of the lineitem-backed facts


# A scan with at least this many splits is parallel enough as it is: spreading it
# would only add a shuffle of the whole table.
SPREAD_MAX_SPLITS = 16


def spread(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Spread a scan that arrives in very few splits (one file with one row
    group) over the session's cores; a no-op for the many-split inputs of a
    cluster, and for any scan with ``SPREAD_MAX_SPLITS`` splits or more.

    With ``by`` (the row identity: ingest position or surrogate key) rows are
    hash-partitioned on it: deterministic on task retry without the per-task
    sort a round-robin repartition needs, and even however skewed the data keys
    are, because the identity is (nearly) unique per row."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Spark Connect session): leave the scan as is
        return df
    if splits >= cores or splits >= SPREAD_MAX_SPLITS:
        return df
    return df.repartition(cores, *by) if by else df.repartition(cores)


# Row identity of each fact table: what ``spread`` hashes on.
FACT_TABLES = {"lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, FACT_TABLES[name]) if name in FACT_TABLES else df


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw measurement rows; ``ingest_batch, ingest_row`` give input order."""
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("int").alias("station_id"),
        F.col("l_returnflag").alias("pollutant_id"),
        F.col("l_shipdate").alias("ts_utc"),
        F.col("l_quantity").alias("value"),
        F.when(F.col("l_linestatus") == "F", F.lit("µg/m³")).otherwise(F.lit("mg/m³")).alias("unit"),
        F.when(F.year("l_shipdate") <= BASE_DATA_END, F.lit("synthetic"))
        .otherwise(F.lit("synthetic_projected")).alias("source"),
        F.col("l_orderkey").alias("ingest_batch"),
        F.col("l_linenumber").alias("ingest_row"),
    )


def text_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurement rows as a text feed delivers them, with the defects that cleaning
    has to meet: missing stations, missing, NaN, negative and infinite values, values that
    are no number, and times that are missing, unreadable, or carry an offset."""
    li = _read(spark, sf_dir, "lineitem")
    number, time = F.col("l_quantity").cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    v, t = F.col("l_partkey") % 23, F.col("l_orderkey") % 19
    return li.select(
        F.when(F.col("l_partkey") % 37 != 0, F.col("l_suppkey")).cast("int").alias("station_id"),
        F.col("l_returnflag").alias("pollutant_id"),
        F.when(t == 0, F.lit("not a time")).when(t == 1, F.concat(time, F.lit("+02:00")))
        .when(t == 2, F.concat(time, F.lit("-05:00"))).when(t == 3, F.concat(time, F.lit("Z")))
        .when(t != 4, time).alias("ts_utc"),
        F.when(v == 1, F.lit("NaN")).when(v == 2, F.concat(F.lit("-"), number)).when(v == 3, F.lit("Infinity"))
        .when(v == 4, F.lit("-Infinity")).when(v == 5, F.lit("n/a")).when(v != 0, number).alias("value"),
        F.col("l_orderkey").alias("ingest_batch"),
        F.col("l_linenumber").alias("ingest_row"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored measurement rows (``measurements_raw`` of the store)."""
    ev = _read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id").alias("measurement_sk"),
        F.col("user_id").cast("int").alias("station_id"),
        F.col("event_type").alias("pollutant_id"),
        F.col("ts").alias("ts_utc"),
        F.col("value"),
        F.lit("µg/m³").alias("unit"),
        F.lit("events").alias("source"),
        (F.col("event_type") != "error").alias("is_valid"),
        F.col("ts").alias("inserted_at"),
        F.when(k % 2 == 0, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("processed_at"),
        F.year("ts").alias("year"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station catalogue of ``readings``; a negative balance gives a NaN latitude."""
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("station_id"),
        F.concat(F.lit("ST-"), F.col("c_custkey").cast("string")).alias("station_code"),
        F.col("c_name").alias("station_name"),
        F.col("c_nationkey").cast("int").alias("zone_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(NAN)).otherwise(F.col("c_acctbal") / F.lit(1000.0)).alias("lat"),
        (F.lit(-66.0) - (F.col("c_custkey") % 13).cast("double")).alias("lon"),
        F.col("c_mktsegment").alias("station_type"),
        F.concat(F.lit("AUTH-"), F.col("c_nationkey").cast("string")).alias("authority"),
        (F.lit(2024) - (F.col("c_custkey") % 5)).cast("int").alias("years_min"),
        F.lit(2024).cast("int").alias("years_max"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station catalogue of ``measurements``."""
    s = _read(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("int").alias("station_id"),
        F.concat(F.lit("ST-"), F.col("s_suppkey").cast("string")).alias("station_code"),
        F.col("s_name").alias("station_name"),
        F.col("s_nationkey").cast("int").alias("zone_id"),
        F.when(F.col("s_acctbal") < 0, F.lit(NAN)).otherwise(F.col("s_acctbal") / F.lit(1000.0)).alias("lat"),
        (F.lit(-66.0) - (F.col("s_suppkey") % 13).cast("double")).alias("lon"),
        F.lit("supplier").alias("station_type"),
        F.concat(F.lit("AUTH-"), F.col("s_nationkey").cast("string")).alias("authority"),
        F.lit(1995).cast("int").alias("years_min"),
        F.lit(2001).cast("int").alias("years_max"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.select(
        F.col("n_nationkey").cast("int").alias("zone_id"),
        F.upper(F.substring(F.md5(F.concat_ws("-", "r_name", "n_name")), 1, 6)).alias("city_code"),
        F.col("r_name").alias("city_name"),
        F.concat(F.lit("Z"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("zone_code"),
        F.concat(F.lit("Zona "), F.col("n_name")).alias("zone_name"),
        (F.lit(50000) + (F.col("n_nationkey") * 104729) % 1450000).cast("int").alias("population"),
        (F.col("n_nationkey").cast("double") * F.lit(0.4) + F.lit(1.0)).alias("centroid_lat"),
        (F.col("n_regionkey").cast("double") * F.lit(2.6) - F.lit(79.0)).alias("centroid_lon"),
    )


def pollutants(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return spark.createDataFrame(DRIVER_POLLUTANTS, schemas.POLLUTANTS)


VIEWS = {
    "measurements": measurements,
    "readings": readings,
    "stations": stations,
    "suppliers": suppliers,
    "zones": zones,
    "pollutants": pollutants,
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)


# ------------------------------------------------------------------------------
# The same views as SQL text (DuckDB dialect) for the oracle queries.
# ------------------------------------------------------------------------------

def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "'NaN'::DOUBLE" if v != v else f"CAST({v!r} AS DOUBLE)"
    return "'" + str(v).replace("'", "''") + "'"


SQL_VIEWS = {
    "measurements": f"""
        SELECT CAST(l_suppkey AS INTEGER) AS station_id, l_returnflag AS pollutant_id,
               l_shipdate AS ts_utc, l_quantity AS value,
               CASE WHEN l_linestatus = 'F' THEN 'µg/m³' ELSE 'mg/m³' END AS unit,
               CASE WHEN year(l_shipdate) <= {BASE_DATA_END} THEN 'synthetic'
                    ELSE 'synthetic_projected' END AS source,
               l_orderkey AS ingest_batch, l_linenumber AS ingest_row
        FROM lineitem""",
    "readings": """
        SELECT event_id AS measurement_sk, CAST(user_id AS INTEGER) AS station_id,
               event_type AS pollutant_id, ts AS ts_utc, value,
               'µg/m³' AS unit, 'events' AS source, event_type <> 'error' AS is_valid,
               ts AS inserted_at,
               CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0
                    THEN ts + INTERVAL 1 HOUR END AS processed_at,
               CAST(year(ts) AS INTEGER) AS year
        FROM events""",
    "stations": """
        SELECT CAST(c_custkey AS INTEGER) AS station_id,
               'ST-' || CAST(c_custkey AS VARCHAR) AS station_code,
               c_name AS station_name, CAST(c_nationkey AS INTEGER) AS zone_id,
               CASE WHEN c_acctbal < 0 THEN 'NaN'::DOUBLE ELSE c_acctbal / 1000.0 END AS lat,
               -66.0 - CAST(c_custkey % 13 AS DOUBLE) AS lon,
               c_mktsegment AS station_type,
               'AUTH-' || CAST(c_nationkey AS VARCHAR) AS authority,
               CAST(2024 - c_custkey % 5 AS INTEGER) AS years_min,
               CAST(2024 AS INTEGER) AS years_max
        FROM customer""",
    "suppliers": """
        SELECT CAST(s_suppkey AS INTEGER) AS station_id,
               'ST-' || CAST(s_suppkey AS VARCHAR) AS station_code,
               s_name AS station_name, CAST(s_nationkey AS INTEGER) AS zone_id,
               CASE WHEN s_acctbal < 0 THEN 'NaN'::DOUBLE ELSE s_acctbal / 1000.0 END AS lat,
               -66.0 - CAST(s_suppkey % 13 AS DOUBLE) AS lon,
               'supplier' AS station_type,
               'AUTH-' || CAST(s_nationkey AS VARCHAR) AS authority,
               CAST(1995 AS INTEGER) AS years_min, CAST(2001 AS INTEGER) AS years_max
        FROM supplier""",
    "zones": """
        SELECT CAST(n_nationkey AS INTEGER) AS zone_id,
               upper(substr(md5(concat_ws('-', r_name, n_name)), 1, 6)) AS city_code,
               r_name AS city_name,
               'Z' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS zone_code,
               'Zona ' || n_name AS zone_name,
               CAST(50000 + (n_nationkey * 104729) % 1450000 AS INTEGER) AS population,
               CAST(n_nationkey AS DOUBLE) * 0.4 + 1.0 AS centroid_lat,
               CAST(n_regionkey AS DOUBLE) * 2.6 - 79.0 AS centroid_lon
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "pollutants": "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in DRIVER_POLLUTANTS)
    + ") AS t(pollutant_id, name, default_unit, who_daily_limit, who_annual_limit)",
}


def with_views(sql: str, names: list[str] | None = None) -> str:
    """Prefix ``sql`` with CTEs for the named views (all views by default)."""
    names = names or list(SQL_VIEWS)
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
