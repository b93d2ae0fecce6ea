import pytest
from pyspark.sql import functions as F

from smogline.functions import text as TX
from smogline.sources import years as Y


def test_title_case_matches_python(spark):
    names = ["san-juan o'neil 3abc  bogotá", "  MEDELLÍN ", "ñuñoa", "São Paulo", "x1y", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(TX.normalize_name("n")).collect()]
    import unicodedata

    def py(n):
        if n is None:
            return ""
        n = unicodedata.normalize("NFD", n.strip())
        return "".join(c for c in n if unicodedata.category(c) != "Mn").title()
    assert got == [py(n) for n in names]


def test_stable_id(spark):
    import hashlib
    df = spark.createDataFrame([("Antioquia-Medellin",)], "t string")
    got = df.select(TX.stable_id("t", length=6, upper=True)).first()[0]
    assert got == hashlib.md5(b"Antioquia-Medellin").hexdigest()[:6].upper()


def test_search(spark):
    df = spark.createDataFrame([("Bogotá Norte",), ("Cali",)], "n string")
    assert df.filter(TX.contains_ci("n", "BOGOT")).count() == 1
    assert df.filter(TX.contains_ci("n", "")).count() == 0


def test_year_modes():
    assert Y.years_to_process(year="2022") == [2022]
    assert Y.years_to_process(year="none", year_start="2022", year_end="2024") == [2022, 2023, 2024]
    assert Y.years_to_process(year="N/A", years="2025, 2022,2024") == [2022, 2024, 2025]
    assert Y.years_to_process(year="2020", years="2022") == [2020]
    with pytest.raises(ValueError):
        Y.years_to_process(year_start="2025", year_end="2022")
    with pytest.raises(ValueError):
        Y.years_to_process(year="empty", years="NULL")
    with pytest.raises(ValueError):
        Y.years_to_process(years="2022,abc")


def test_year_status(spark):
    req = Y.requested_years(spark, [2020, 2021, 2022])
    src = spark.createDataFrame([("2021-05-01 00:00:00",), ("2022-01-01 00:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("ts_utc"))
    tgt = src.filter(F.year("ts_utc") == 2022)
    got = {r.year: r.status for r in Y.year_status(req, src, tgt).collect()}
    assert got == {2020: "failed", 2021: "success", 2022: "skipped"}


def test_check_status(spark):
    st = spark.createDataFrame([(2020, "failed"), (2021, "success")], "year int, status string")
    assert Y.check_status(st, fail_on_error=False).count() == 2
    with pytest.raises(RuntimeError):
        Y.check_status(st, fail_on_error=True)


def test_deep_page_matches_top_k(spark):
    from smogline.operators import lookup as L
    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"), F.col("id")).repartition(9)
    for skip, limit in ((0, 10), (100, 100), (2950, 100), (1234, 567)):
        top = [r.k for r in L.page(df, "k", skip, limit).collect()]
        deep = sorted(r.k for r in L.page(df, "k", skip, limit, deep_rows=0).collect())
        assert sorted(top) == deep == list(range(skip, min(skip + limit, 3000))), (skip, limit)


def test_offsets_are_applied(spark):
    from smogline.functions.calendar import parse_iso_utc
    from smogline.functions.numeric import number_from_text
    rows = ["2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00-05:00", "2024-01-01T00:00:00Z", "2024-01-01 03:04:05.5",
            "2024-01-01", "not-a-date", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = [str(r[0]) for r in df.select(parse_iso_utc("t")).collect()]
    assert got == ["2023-12-31 22:00:00", "2024-01-01 05:00:00", "2024-01-01 00:00:00", "2024-01-01 03:04:05.500000",
                   "2024-01-01 00:00:00", "None", "None"]
    nums = spark.createDataFrame([(t,) for t in ("1,234.5", "NaN", "x")], "t string")
    assert [r[0] for r in nums.select(number_from_text("t")).collect()] == [1234.5, None, None]
