import os
import tempfile
import time

from pyspark.sql import functions as F

from smogline.operators import validation as V
from smogline.sources import base_csv as B
from smogline.sources import years as Y

HEADER = [" ID Estacion", "Estación ", "Autoridad Ambiental", "Nombre del Departamento", "Nombre del Municipio",
          "Variable", "Año", "Promedio", "Latitud", "Longitud", "Tipo de Estación"]
ROWS = [
    ['"1,234"', "", "CAR", "Cundinamarca", "Bogotá", "PM2.5", "2019", '"1,234.5"', "4.6", "-74.1", "Urbana"],
    ['"1,234"', "Estación Norte", "CAR", "Cundinamarca", "Bogotá", "PM10", "2020", "20", "4.6", "-74.1", "Urbana"],
    ["77", "san-juan o'neil", "AMVA", "Antioquia", "San Juan", "Benzene", "2020", "3", "6.2", "-75.5", "Rural"],
    ["77", "san-juan o'neil", "AMVA", "Antioquia", "San Juan", "NO2", "2021", "7", "6.2", "-75.5", "Rural"],
    ["X-9", "bad", "AMVA", "Huila", "San Juan", "O3", "2021", "7", "1", "1", "Rural"],
]


def _write_csv(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(HEADER) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_csv_source_trims_headers_parses_numbers(spark):
    d = tempfile.mkdtemp(prefix="smogline-csv-")
    _write_csv(f"{d}/base.csv", ROWS)
    raw = B.read_base_csv(spark, f"{d}/base.csv")
    assert "ID Estacion" in raw.columns and "Estación" in raw.columns
    typed = B.typed_base(raw)
    rows = typed.collect()
    assert len(rows) == 4                         # Benzene dropped
    assert {r.value for r in rows} >= {1234.5, 20.0}
    assert {r.station_raw for r in rows} == {"1,234", "77", "X-9"}


def test_csv_source_missing_column(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="smogline-csv-")
    with open(f"{d}/bad.csv", "w") as f:
        f.write("a,b\n1,2\n")
    with pytest.raises(ValueError):
        B.read_base_csv(spark, f"{d}/bad.csv")


def test_newest_file(spark):
    d = tempfile.mkdtemp(prefix="smogline-csv-")
    _write_csv(f"{d}/old.csv", ROWS[:2])
    old = time.time() - 3600
    os.utime(f"{d}/old.csv", (old, old))
    _write_csv(f"{d}/new.csv", ROWS[2:])
    got = B.newest_file(spark, f"{d}/*.csv")
    assert got.count() == 3
    assert got.select("_pos.f").distinct().first()[0].endswith("new.csv")


def test_read_years_prunes(spark):
    d = tempfile.mkdtemp(prefix="smogline-years-")
    df = spark.range(0, 30).select(F.col("id"), (F.lit(2020) + F.col("id") % 3).cast("int").alias("year"))
    df.write.partitionBy("year").parquet(f"{d}/facts")
    got = Y.read_years(spark, f"{d}/facts", [2021, 2022])
    assert got.count() == 20
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2021" in plan


def test_validation_rule_sets(spark):
    st = spark.createDataFrame([("1", "ST-1", "n", "3", "4.5", "", "t", "a", "2020", ""),
                                ("x", "", "n" * 201, None, "abc", "1", "t", "a", "", "")],
                               "station_id string, station_code string, station_name string, zone_id string, "
                               "lat string, lon string, station_type string, authority string, "
                               "years_min string, years_max string")
    out = {r.station_id: r.errors for r in V.validate(st, V.station_rules()).collect()}
    assert out["1"] == ""
    assert out["x"] == ("station_id: not an integer; station_code: required; station_name: longer than 200; "
                        "zone_id: required; lat: not a decimal")
    caps = spark.createDataFrame([("1", "pm25" * 6, "u")], "station_id string, pollutant_id string, unit string")
    assert V.validate(caps, V.capability_rules()).first().errors == "pollutant_id: longer than 20"
    ok, bad = V.split_valid(V.validate(st, V.station_rules()))
    assert ok.count() == 1 and bad.count() == 1


def test_spread_only_narrow_scans(spark):
    from smogline.sources import driver_tables as dt
    d = tempfile.mkdtemp(prefix="smogline-spread-")
    spark.range(0, 1000).coalesce(1).write.parquet(f"{d}/one")
    one = spark.read.parquet(f"{d}/one")
    spread = dt.spread(one, ["id"])
    cores = spark.sparkContext.defaultParallelism
    assert spread.rdd.getNumPartitions() == cores
    sizes = spread.rdd.glom().map(len).collect()
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) < 1000 // cores  # even by identity hash
    wide = spark.range(0, 1000, numPartitions=max(cores, dt.SPREAD_MAX_SPLITS))
    assert dt.spread(wide, ["id"]) is wide
