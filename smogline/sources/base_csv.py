"""The annual-averages CSV (op A1, A2) and its typed form.

``read_base_csv`` reads the real file; ``driver_base_rows`` renders the same
eleven text columns from the driver tables (lineitem + supplier + nation +
region) so the catalogue and generator plans run on the given data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.numeric import number_from_text
from ..operators.joins import lookup
from ..operators.positions import SPLIT
from .driver_tables import _read

COLS = K.CSV_COLUMNS
POS = "_pos"  # ingest position (orderable struct or number)


def check_columns(df: DataFrame, required) -> DataFrame:
    """Fail when a required column is missing (op B12)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_base_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column as text, trimmed header names, ingest
    position attached right after the scan (op A1): the file, the first byte of the split, and the
    row's place after it. Splits are ordered by where they lie in the file, however tasks
    pack them, so order by position is the order of the rows in the files. Emptiness is checked by the
    caller's plan (``require_rows``), not by a count here."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").option("inferSchema", False).csv(path)
    df = raw.toDF(*[c.strip() for c in raw.columns])
    check_columns(df, COLS.values())
    return df.withColumn(POS, F.struct(F.col("_metadata.file_path").alias("f"),
                                       F.col("_metadata.file_block_start").alias(SPLIT),
                                       F.monotonically_increasing_id().alias("i")))


def newest_file(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of the most recently modified CSV among ``pattern`` (op A2). The
    listing is a distributed scan of file metadata only (the ``binaryFile``
    source without its content column, so no file body is read); the newest
    path (one scalar, ties to the larger path) comes back and only that file is
    read, as ``read_base_csv`` reads it."""
    listing = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    newest = listing.orderBy(F.col("modificationTime").desc(), F.col("path").desc()).select("path").first()
    if newest is None:
        raise FileNotFoundError(f"no file matches {pattern}")
    return read_base_csv(spark, newest["path"])


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise at run time when ``df`` has no rows (cheap: one row is enough)."""
    if df.limit(1).count() == 0:
        raise ValueError(f"{what} has no rows")
    return df


# --- fixed values: mapping of lineitem rows onto the CSV's variable names -------
# l_partkey % 7 picks one of the six known names, or an unknown one (dropped by B2).
VARIABLE_BY_PART = ["PM2.5", "PM10", "O3", "NO2", "SO2", "CO", "Benzene"]


POSITION_KEYS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]


def driver_position(lineitem: DataFrame) -> Column:
    """The keys that order the rows as one number, so that a first position is found by a hash aggregate: each key
    less its least value, in as many values as there are between its least and its largest (a row of
    scalars to the driver). A struct of the keys if that would pass 38 digits or a key is null."""
    ends = lineitem.agg(F.count(F.lit(1)), *(f(k) for k in POSITION_KEYS for f in (F.count, F.min, F.max))).first()
    n, of_key = ends[0], [ends[1 + 3 * i:4 + 3 * i] for i in range(len(POSITION_KEYS))]
    if not n or any(found < n for found, _, _ in of_key):
        return F.struct(*POSITION_KEYS).alias(POS)
    values = [high - low + 1 for _, low, high in of_key]
    kind = "long" if math.prod(values) < 2**62 else "decimal(38,0)" if math.prod(values) < 10**37 else None
    if kind is None:
        return F.struct(*POSITION_KEYS).alias(POS)
    out = None
    for k, (_, low, _), size in zip(POSITION_KEYS, of_key, values):
        place = (F.col(k) - F.lit(low)).cast(kind)
        out = place if out is None else (out * F.lit(size).cast("long" if kind == "long" else "decimal(19,0)") + place).cast(kind)
    return out.alias(POS)


def driver_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions of all rows of ``driver_base_rows`` alone: a scan of four columns."""
    li = _read(spark, sf_dir.rstrip("/"), "lineitem")
    return li.select(driver_position(li))


def driver_base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sf_dir.rstrip("/")
    li = _read(spark, d, "lineitem")
    position = driver_position(li)
    s = spark.read.parquet(f"{d}/supplier.parquet")
    n = spark.read.parquet(f"{d}/nation.parquet")
    r = spark.read.parquet(f"{d}/region.parquet")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    sup = s.join(geo, s.s_nationkey == geo.n_nationkey, "left")
    # The supplier side is a catalogue: a size-checked broadcast, so a supplier
    # holding a third of the rows is never hashed into one task.
    j = lookup(li, sup, li.l_suppkey == sup.s_suppkey)
    var = F.element_at(F.array(*[F.lit(v) for v in VARIABLE_BY_PART]), (F.col("l_partkey") % 7 + 1).cast("int"))
    return j.select(
        F.format_number(F.col("l_suppkey"), 0).alias(COLS["station_id"]),
        F.col("s_name").alias(COLS["station"]),
        F.concat(F.lit("AUTH-"), F.col("s_nationkey").cast("string")).alias(COLS["authority"]),
        F.col("r_name").alias(COLS["dept"]),
        F.col("n_name").alias(COLS["muni"]),
        var.alias(COLS["pollutant"]),
        F.year("l_shipdate").cast("string").alias(COLS["year"]),
        F.format_number(F.col("l_quantity") * F.lit(1000) + F.col("l_partkey") % 997, 0).alias(COLS["value"]),
        (F.col("s_acctbal") / F.lit(1000.0)).cast("string").alias(COLS["lat"]),
        (F.lit(-66.0) - (F.col("s_suppkey") % 13).cast("double")).cast("string").alias(COLS["lon"]),
        F.when(F.col("l_suppkey") % 2 == 0, F.lit("Urbana")).otherwise(F.lit("Rural")).alias(COLS["station_type"]),
        position,
    )


def typed_base(df: DataFrame) -> DataFrame:
    """English names, numeric text parsed (B1), only the six known variables (B2)."""
    c = COLS
    known = [p[0] for p in K.POLLUTANTS]
    out = df.select(
        F.col(c["station_id"]).cast("string").alias("station_raw"),
        F.col(c["station"]).alias("station_name"),
        F.col(c["authority"]).alias("authority"),
        F.col(c["dept"]).alias("dept"),
        F.col(c["muni"]).alias("muni"),
        F.trim(F.col(c["pollutant"])).alias("variable"),
        number_from_text(c["year"]).alias("year"),
        number_from_text(c["value"]).alias("value"),
        number_from_text(c["lat"]).alias("lat"),
        number_from_text(c["lon"]).alias("lon"),
        F.col(c["station_type"]).alias("station_type"),
        F.col(POS),
    )
    return out.filter(F.col("variable").isin(known))


COMPACT_SUM, COMPACT_N = "v_sum", "v_n"


def compact_rows(typed: DataFrame) -> DataFrame:
    """Typed rows collapsed to one row per distinct combination of the text and
    year columns, with the earliest ingest position and the sum and count of the
    values. Every catalogue and trend aggregate reads this instead of the raw
    rows, and gets the same answer: a "first non-null in input order" is the
    value of the combination with the smallest position among those where it
    is non-null, min/max year are keys, and means are sums over counts. The
    raw rows are grouped (map-side combined) once; a hot station is collapsed
    before its shuffle."""
    keys = [c for c in typed.columns if c not in (POS, "value")]
    return typed.groupBy(*keys).agg(F.min(POS).alias(POS), F.sum("value").alias(COMPACT_SUM),
                                    F.count("value").alias(COMPACT_N))


def station_key(raw: Column | str) -> Column:
    """Station id text with thousands separators removed."""
    col = F.col(raw) if isinstance(raw, str) else raw
    return F.trim(F.regexp_replace(col.cast("string"), ",", ""))
