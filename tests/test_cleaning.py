import math

from pyspark.sql import types as T

from pyspark.sql import functions as F

from smogline.operators import cleaning as C

SCHEMA = T.StructType([
    T.StructField("station_id", T.IntegerType()), T.StructField("pollutant_id", T.StringType()),
    T.StructField("ts_utc", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("pos", T.IntegerType()),
])

# FIXTURES.md §7
ROWS = [
    (1, "pm25", "2024-01-01T00:00:00Z", 10.0, "u", "s", 1),
    (1, "pm25", "2024-01-01T00:00:00Z", 11.0, "u", "s", 2),
    (None, "pm25", "2024-01-02T00:00:00Z", -1.0, "u", "s", 3),
    (1, "pm25", "2024-01-02T00:00:00Z", math.nan, "u", "s", 4),
    (1, "pm25", "2024-01-03T00:00:00Z", -0.5, "u", "s", 5),
    (1, "pm25", "2024-01-04T00:00:00Z", math.inf, "u", "s", 6),
    (1, "pm25", "not-a-date", 5.0, "u", "s", 7),
    (1, "pm25", "2024-01-05T00:00:00Z", 0.0, "u", "s", 8),
]


def test_cleaning_report_counts_sequentially(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    r = C.cleaning_report(df).first().asDict()
    assert r["initial_count"] == 8
    assert r["nulls_removed"] == 2
    assert r["negative_values"] == 1
    assert r["non_finite_values"] == 1
    assert r["invalid_timestamps"] == 1
    assert r["duplicates_removed"] == 1
    assert r["final_count"] == 2
    assert r["removed_pct"] == 75.0


def test_clean_keeps_last_duplicate_and_zero(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = sorted((r.value, str(r.ts_utc)) for r in C.clean_measurements(df, ["pos"]).collect())
    assert out == [(0.0, "2024-01-05 00:00:00"), (11.0, "2024-01-01 00:00:00")]


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    once = C.clean_measurements(df, ["pos"], drop_order=False)
    twice = C.clean_measurements(once, ["pos"], drop_order=False)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_keep_first_for_capabilities(spark):
    df = spark.createDataFrame([(1, "pm25", "a", 1), (1, "pm25", "b", 2), (2, "o3", "c", 3)],
                               "station_id int, pollutant_id string, unit string, pos int")
    out = {(r.station_id, r.pollutant_id): r.unit
           for r in C.keep_one(df, ["station_id", "pollutant_id"], ["pos"], last=False).collect()}
    assert out == {(1, "pm25"): "a", (2, "o3"): "c"}


def test_ranges(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-15 00:00:00",), ("2024-01-15 08:00:00",)],
                               "t string").selectExpr("cast(t as timestamp_ntz) as ts_utc")
    assert C.time_range(df, "2024-01-01", "2024-01-15").count() == 1
    assert C.closed_range(df, "2024-01-01", "2024-01-15").count() == 2


def test_fail_on_null_key(spark):
    import pytest
    df = spark.createDataFrame([("a",), (None,)], "pollutant_id string")
    with pytest.raises(Exception):
        C.fail_on_null_key(df).collect()


def test_packed_order_sorts_as_the_columns_do(spark):
    """Whole-number orders, nulls and extremes included, pick the row that comparing structs picks."""
    low, high = -2**63, 2**63 - 1
    orders = [(a, b) for a in (None, low, -1, 0, 7, high) for b in (None, -2**31, 0, 2**31 - 1)]
    rows = [(k, float(n), a, b) for n, (a, b) in enumerate(orders) for k in (1, 2) if k == 1 or n % 3]
    df = spark.createDataFrame(rows, "k int, value double, a bigint, b int")
    wide = df.withColumn("note", F.lit("text"))
    for last in (True, False):
        got = C.keep_one(df, ["k"], ["a", "b"], last)
        assert "SortAggregate" not in got._jdf.queryExecution().toString()
        want = C.keep_one(wide, ["k"], ["a", "b"], last).drop("note")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
