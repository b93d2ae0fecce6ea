import math

from pyspark.sql import functions as F

from smogline import constants as K
from smogline.operators import enrich as E
from smogline.schemas import ENRICHED_COLUMNS


def test_compliance_table(spark):
    # FIXTURES.md §8
    rows = [(16.0, 15.0, 5.0), (15.0, 15.0, 5.0), (5.0, 15.0, 5.0), (101.0, 100.0, None), (99.0, None, None)]
    df = spark.createDataFrame(rows, "v double, d double, a double")
    got = [r.s for r in df.select(E.compliance_status("v", "d", "a").alias("s")).collect()]
    assert got == [K.STATUS_DAILY, K.STATUS_ANNUAL, K.STATUS_OK, K.STATUS_DAILY, K.STATUS_OK]


def test_nan_limit_reads_as_null(spark):
    p = spark.createDataFrame([("x", "X", "u", math.nan, 150.0)],
                              "pollutant_id string, name string, default_unit string, "
                              "who_daily_limit double, who_annual_limit double")
    d = E.pollutant_dim(p).first()
    assert d.who_daily_limit is None and d.who_annual_limit == 150.0


def test_flagship_on_small_tables(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == [c for c, _ in ENRICHED_COLUMNS]
    rows = df.collect()
    assert len(rows) > 0
    # Sunday = 0 .. Saturday = 6
    assert {r.day_of_week for r in rows} <= set(range(7))
    # NaN latitudes are gone
    assert not any(r.station_latitude is not None and math.isnan(r.station_latitude) for r in rows)
    assert {r.is_valid for r in rows} == {1}


def test_day_of_week_sunday_zero(spark):
    df = spark.createDataFrame([("2024-01-07 10:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    from smogline.functions import calendar as cal
    assert df.select(cal.day_of_week_sunday0("t")).first()[0] == 0


def test_extract_cutoff():
    import datetime as dt
    assert E.extract_cutoff(0) == K.EXTRACT_FLOOR_DATE
    assert E.extract_cutoff(-3) == K.EXTRACT_FLOOR_DATE
    assert E.extract_cutoff(10, dt.date(2024, 1, 31)) == "2024-01-21"


def test_newest_n_matches_brute_force(spark):
    """Top-N by (ts desc, sk desc) against a plain sort: a hot day holding most
    rows, equal timestamps, and N below, inside and beyond one day's rows."""
    df = spark.range(0, 3000).select(
        F.col("id").alias("measurement_sk"),
        # 2000 rows on one hot day (many share a timestamp), the rest over 20 days.
        F.when(F.col("id") < 2000,
               F.expr("timestamp_ntz'2024-03-10 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 37)"))
        .otherwise(F.expr("timestamp_ntz'2024-02-01 06:00:00' + make_interval(0, 0, 0, id % 20, id % 24, 0, 0)"))
        .alias("ts_utc")).repartition(7)
    rows = sorted(((r.ts_utc, r.measurement_sk) for r in df.collect()), reverse=True)
    for n in (1, 50, 1999, 2000, 2001, 2500, 3000, 5000):
        got = sorted(((r.ts_utc, r.measurement_sk) for r in E.newest_n(df, n).collect()), reverse=True)
        assert got == rows[:n], n


def test_plans_push_filters_and_prune_columns(spark):
    """Plan quality: the flagship's extract filter reaches the Parquet scan, and the
    cleaned facts read only the lineitem columns they map."""
    import __spark_entry__ as SE
    from tests.conftest import SF_SMALL

    def plan(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        return df._jdf.queryExecution().explainString(mode)

    flagship = plan(SE.queries()["enriched_fact"](spark, SF_SMALL))
    pushed = [line for line in flagship.split("\n") if line.startswith("PushedFilters: [IsNotNull(ts)")][0]
    assert "IsNotNull(ts)" in pushed and "Not(EqualTo(event_type,error))" in pushed
    clean = plan(SE.queries()["clean_measurements"](spark, SF_SMALL))
    schema = clean[clean.index("ReadSchema: struct<"):].split(">")[0]
    assert "l_shipdate" in schema and "l_quantity" in schema
    for unused in ("l_partkey", "l_extendedprice", "l_discount", "l_tax"):
        assert unused not in schema
