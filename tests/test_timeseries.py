from pyspark.sql import functions as F

from smogline.operators import timeseries as TS


def _series(spark, rows):
    return spark.createDataFrame(rows, "station_id int, pollutant_id string, t string, value double") \
        .withColumn("ts_utc", F.col("t").cast("timestamp_ntz")).drop("t")


def test_daily_derivative_fixture(spark):
    # FIXTURES.md §9: 10, 13, 9 at day 0, 1, 3 -> 3.0 and -2.0
    df = _series(spark, [(1, "pm25", "2024-01-01 00:00:00", 10.0), (1, "pm25", "2024-01-02 00:00:00", 13.0),
                         (1, "pm25", "2024-01-04 00:00:00", 9.0)])
    got = sorted((r.day, r.daily_rate) for r in TS.daily_derivative(df).collect())
    assert got == [(2, 3.0), (4, -2.0)]


def test_daily_derivative_crosses_chunks(spark):
    rows = [(1, "a", f"2024-{m:02d}-{d:02d} 00:00:00", float(m * 100 + d)) for m in (1, 2, 5) for d in (1, 15, 28)]
    df = _series(spark, rows)
    by_month = sorted((str(r.time), r.daily_rate) for r in TS.daily_derivative(df, chunk="month").collect())
    by_year = sorted((str(r.time), r.daily_rate) for r in TS.daily_derivative(df, chunk="year").collect())
    by_day = sorted((str(r.time), r.daily_rate) for r in TS.daily_derivative(df, chunk="day").collect())
    by_auto = sorted((str(r.time), r.daily_rate)
                     for r in TS.daily_derivative(df, chunk="auto", rows_per_chunk=2).collect())
    assert by_month == by_year == by_day == by_auto
    assert len(by_month) == len(rows) - 1


def test_rate_times_elapsed_telescopes(spark):
    rows = [(1, "a", f"2024-01-{d:02d} 0{d % 10}:00:00", float((d * 37) % 11)) for d in range(1, 29, 3)]
    df = _series(spark, rows)
    out = TS.daily_derivative(df).orderBy("time").collect()
    ts = [r.ts_utc for r in df.orderBy("ts_utc").collect()]
    vals = [r.value for r in df.orderBy("ts_utc").collect()]
    total = sum(r.daily_rate * (ts[i + 1] - ts[i]).total_seconds() / 86400 for i, r in enumerate(out))
    assert abs(total - (vals[-1] - vals[0])) < 1e-9


def test_monthly_derivative_fixture(spark):
    # Jan mean 10, Feb mean 16, (March empty), Apr 10 -> +6 (label 1 March), -3 (label 1 May)
    df = _series(spark, [(1, "a", "2024-01-05 00:00:00", 8.0), (1, "a", "2024-01-20 00:00:00", 12.0),
                         (1, "a", "2024-02-10 00:00:00", 16.0), (1, "a", "2024-04-02 00:00:00", 10.0)])
    got = sorted((str(r.time), r.monthly_rate) for r in TS.monthly_derivative(df).collect())
    assert got == [("2024-03-01 00:00:00", 6.0), ("2024-05-01 00:00:00", -3.0)]
    clipped = TS.monthly_derivative(df, stop="2024-04-15 00:00:00").collect()
    assert sorted(str(r.time) for r in clipped) == ["2024-03-01 00:00:00", "2024-04-15 00:00:00"]


def test_epoch365_year_edge(spark):
    # FIXTURES.md §10
    df = _series(spark, [(1, "a", "2023-12-20 00:00:00", 1.0)])
    assert TS.yearly_stats(df).first().year == 2023
    assert TS.yearly_stats(df, year_mode="epoch365").first().year == 2024


def test_peaks_ties_earliest(spark):
    df = _series(spark, [(1, "a", "2024-01-03 00:00:00", 5.0), (1, "a", "2024-01-01 00:00:00", 5.0),
                         (1, "a", "2024-01-02 00:00:00", 1.0), (1, "a", "2024-01-04 00:00:00", 1.0)])
    r = TS.peaks_valleys(df).first()
    assert str(r.peak_time) == "2024-01-01 00:00:00" and r.peak_value == 5.0
    assert str(r.valley_time) == "2024-01-02 00:00:00" and r.valley_value == 1.0


def test_time_span_whole_days(spark):
    from smogline.operators import stats as S
    df = _series(spark, [(1, "a", "2024-01-01 12:00:00", 1.0), (1, "a", "2024-01-03 06:00:00", 2.0)])
    assert S.time_span(df).first().days == 1


def test_chunks_are_bounded_by_rows_in_a_burst(spark):
    """Nine tenths of a series on its last day: still no chunk above the bound."""
    df = (spark.range(2000).select(
        F.lit(1).alias("station_id"), F.lit("NO2").alias("pollutant_id"), F.col("id").cast("double").alias("value"),
        F.when(F.col("id") < 200, F.timestamp_seconds(F.col("id") * 86400))
         .otherwise(F.timestamp_seconds(200 * 86400 + F.col("id"))).cast("timestamp_ntz").alias("ts_utc")))
    sizes = [r["count"] for r in TS._with_chunks(df, "auto", 100).groupBy("_chunk").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 100
    rates = TS.daily_derivative(df, rows_per_chunk=100)
    assert rates.count() == 1999
