"""Sinks and output checks (ops A3, A8-A13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from . import versions
from .base_csv import check_columns, require_rows

#: Rows that a file of a year holds, about.
ROWS_PER_FILE = 5_000_000


def read_catalogue(spark: SparkSession, path: str, schema, required=None) -> DataFrame:
    """A catalogue in Parquet with a declared schema; error when empty or when a
    required column is missing (ops A3, B12). The files' own schema is checked:
    reading by the declared one would fill what is missing with NULLs."""
    path = versions.live_path(spark, path)
    check_columns(spark.read.parquet(path), required or [f.name for f in schema.fields])
    return require_rows(spark.read.schema(schema).parquet(path), path)


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 64,
              fetchsize: int = 5000, **props) -> DataFrame:
    """JDBC source with a pushed-down subquery (op A8), split into ``partitions``
    range reads on ``partition_column`` instead of one connection."""
    if partition_column is not None:
        if lower is None or upper is None or int(lower) >= int(upper):
            raise ValueError("a partitioned JDBC read needs lower < upper bounds on the partition column")
        if partitions < 1:
            raise ValueError("partitions must be at least 1")
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS q")
         .option("fetchsize", str(fetchsize)))
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    for k, v in props.items():
        r = r.option(k, v)
    return r.load()


def files_by_year(rows_by_year: dict[int, int], rows_per_file: int = ROWS_PER_FILE) -> dict[int, int]:
    """Files of each year that hold about ``rows_per_file`` rows."""
    return {y: max(1, -(-n // rows_per_file)) for y, n in rows_by_year.items()}


def file_places(files: dict[int, int], *key: str) -> tuple[int, Column]:
    """The number of files, and a row's file by its ``year`` and a hash of ``key``. A year that ``files`` lacks (rows
    may arrive while it is counted) goes to the first."""
    first = F.lit(None).cast("int")
    count, at = F.lit(None).cast("int"), 0
    for y, n in sorted(files.items(), key=lambda x: (x[0] is None, x[0])):
        here = F.col("year").eqNullSafe(F.lit(y))
        first, count = F.when(here, F.lit(at)).otherwise(first), F.when(here, F.lit(n)).otherwise(count)
        at += n
    return at, F.coalesce(first + F.pmod(F.xxhash64(*key), count).cast("int"), F.lit(0))


def write_facts_by_year(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE,
                        rows_by_year: dict[int, int] | None = None, dealt: bool = False) -> None:
    """One dataset partitioned by year (snappy by default) (op A9). With
    dynamic partition overwrite only the years present in ``df`` are replaced.

    A histogram of rows by year (counted here unless the caller has it) sets the number of files of each
    year, and each file is one task's: a small year is one file, and one that holds most rows is written by as many
    tasks as it needs. Rows go to a year's files by a hash of the natural key, so files hold about
    ``rows_per_file`` rows, and never more than twice as many. ``dealt`` rows lie in their files' tasks
    already (``file_places``) and are written without a shuffle."""
    if not dealt:
        if rows_by_year is None:  # a row for each year: bounded by the calendar
            rows_by_year = {r["year"]: r["count"] for r in df.groupBy("year").count().collect()}
        files = files_by_year(rows_by_year, rows_per_file)
        if files:
            df = df.repartitionById(*file_places(files, "station_id", "pollutant_id", "ts_utc"))
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 2 * rows_per_file)
       .partitionBy("year").parquet(path))


def write_table(df: DataFrame, path: str) -> dict:
    """Truncate-and-load / staging overwrite (ops A10, A11): a whole replace, as a new version. Readers
    (``read_table``) see the old rows until all new ones are written, and keep them if the run fails."""
    return versions.publish(df, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a table written by ``write_table``, or of a plain Parquet folder."""
    return versions.read_live(spark, path)


def points(df: DataFrame, measurement: str = "air_quality") -> DataFrame:
    """Time-series points (op A12): tags station_id, pollutant_id and, when
    non-empty, unit, source and a year other than 0; field ``value``; second precision; a missing
    time becomes now. Points with equal (tags, time) overwrite each other, the
    last written (highest measurement_sk) wins."""
    def tag(c):
        t = F.col(c).cast("string")
        return F.when(t.isNotNull() & (t != "") & ((F.lit(c) != "year") | (t != "0")), t).alias(c)
    ts = F.date_trunc("second", F.coalesce(cal.as_wall_clock("ts_utc"),
                                            F.current_timestamp().cast("timestamp_ntz"))).cast("timestamp_ntz")
    p = df.select(F.lit(measurement).alias("measurement"),
                  F.col("station_id").cast("string").alias("station_id"),
                  F.col("pollutant_id").cast("string").alias("pollutant_id"),
                  tag("unit"), tag("source"), tag("year"),
                  ts.alias("time"), F.col("value").cast("double").alias("value"), "measurement_sk")
    keys = ["measurement", "station_id", "pollutant_id", "unit", "source", "year", "time"]
    # Grouping treats NULL tags as equal, as an absent tag is.
    g = p.groupBy(*keys).agg(F.max_by(F.struct("value", "measurement_sk"), F.col("measurement_sk")).alias("_w"))
    return g.select(*keys, F.col("_w.value").alias("value"), F.col("_w.measurement_sk").alias("measurement_sk"))


def loaded_years(spark: SparkSession, path: str) -> list[int]:
    """Years of a dataset partitioned by ``year`` that hold files, from the listing of its folders (op A6)."""
    found = []
    for folder in versions.names(spark, path):
        year = folder.partition("year=")[2]
        if year.isdigit() and any(not f.startswith(("_", ".")) for f in versions.names(spark, f"{path.rstrip('/')}/{folder}")):
            found.append(int(year))
    return sorted(found)


def output_check(spark: SparkSession, tables: dict[str, str], facts: str) -> DataFrame:
    """What a run has left: the number of rows of each catalogue written by ``write_table`` and of years of the
    facts written by ``write_facts_by_year``; ``ok`` when there is at least one (op A13). It is
    answered from manifests, footers and the listing of folders: no column is read. A missing
    output counts 0."""
    rows = []
    for name, path in tables.items():
        entries = versions.manifest(spark, path)
        if entries is None and versions.exists(spark, path):
            entries = {"rows": spark.read.parquet(path).count()}  # a plain folder: from footers
        rows.append((name, entries["rows"] if entries else 0))
    rows.append(("measurement_years", len(loaded_years(spark, facts))))
    return spark.createDataFrame(rows, "table string, n long").withColumn("ok", F.col("n") > 0)
