"""The generator's days at scale: hashes in bulk, spikes without a window over the days, years dealt before their days."""

import hashlib
import math
import tempfile

import numpy as np
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions import hashing as H
from smogline.functions.numeric import bround
from smogline.operators import synth as SY
from smogline.sources import sinks as S

WIN = SY.Window_(start_year=2019, end_year=2021, base_data_end=2020, end_date="2021-03-31")


def _plan(spark):
    rows = [(1, "pm25", "µg/m³", 20.0, 0.05, "2019-01-01", "2021-03-31", True), (2, "co", "mg/m³", 1.5, 0.0, "2020-01-01", "2020-12-31", False),
            (30, "no2", "µg/m³", 25000.0, -0.1, "2021-01-01", "2021-01-20", True), (4, "o3" * 30, "µg/m³", 0.0, 0.1, "2019-12-30", "2020-01-02", False)]
    df = spark.createDataFrame(rows, "station_id int, pollutant_id string, unit string, annual_mean double, trend double, f string, l string, is_extended boolean")
    return df.withColumns({"first_day": F.col("f").cast("date"), "last_day": F.col("l").cast("date")}).drop("f", "l")


def _plain(plan):
    """Each day as a row of its own: column hashes and a window over the days."""
    days = plan.withColumn("d", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))))
    m, key = F.col("annual_mean"), ("station_id", "pollutant_id", "d")
    years = F.datediff(F.col("d"), F.lit("2020-12-31").cast("date")) / F.lit(K.DAYS_PER_YEAR)
    adj = F.when(F.col("is_extended") & (F.col("trend") != 0), m * F.pow(1 + F.col("trend"), years)).otherwise(m)
    v = adj + K.NOISE_SD_FRACTION * adj * H.standard_normal(*key, salt="noise")
    v = v + K.SEASONAL_AMPLITUDE * m * F.sin(2 * math.pi * F.dayofyear("d") / K.SEASON_PERIOD)
    week = F.when(F.weekday("d") >= 5, K.WEEKEND_EFFECT).otherwise(K.WEEKDAY_EFFECT) * adj
    v = v + F.when(F.col("pollutant_id").isin(*K.WEEKLY_POLLUTANTS), week).otherwise(0.0)
    x = SY.with_spikes(days.withColumn("v", v)).withColumn("v", F.greatest(F.col("v") * F.col("_spike"), F.lit(0.0)))
    return {(r.station_id, r.ts): r.value for r in x.select(
        "station_id", F.date_format("d", "yyyy-MM-dd'T'00:00:00'Z'").alias("ts"),
        F.when(F.col("pollutant_id") == "co", F.bround("v", 1)).otherwise(F.bround("v", 2)).alias("value")).collect()}


def test_hashes_in_bulk():
    texts = [f"2020-01-{d:02d}".encode() for d in range(1, 32)]
    for size in (0, 1, 2, 3, 7, 33, 34, 60):
        heads = [b"x" * size, b"y" * (size // 2)]
        got = H.JoinedHashes(texts).md5(heads, [slice(2, 31), np.array([4, 0])], np.array([29, 2]), "noise")
        want = [hashlib.md5(heads[0] + t + b"|noise").hexdigest() for t in texts[2:]]
        want += [hashlib.md5(heads[1] + texts[i] + b"|noise").hexdigest() for i in (4, 0)]
        assert ["".join(f"{int(w):08x}" for w in words) for words in zip(*got)] == want
        for part in (0, 1):
            assert H.top_bits(got, part).tolist() == [int(h[13 * part:13 * part + 13], 16) for h in want]


def test_rounding_near_ties(spark):
    values = [0.005, 0.015, 0.025, 2.675, 1.005, 12.345, 12.355, 99.995, 1e12 + 0.125, 0.0, 7.0, 0.0149999999, 3.14159]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for digits in (1, 2):
        assert all(a == b for a, b in df.select(bround("x", digits), F.bround("x", digits)).collect())


def test_days_equal_the_plain_form_without_sorting_them(spark):
    plan = _plan(spark)
    want = _plain(plan)
    whole = SY.daily_series(plan, WIN, partitions=3)
    assert "Window" not in whole._jdf.queryExecution().executedPlan().toString()
    files = S.files_by_year(SY.days_by_year(plan), 300)
    by_year = SY.daily_series(plan, WIN, 3, files)
    text = by_year._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text[:text.index("MapInArrow")]  # the plan is shuffled, the days are not
    for series in (whole, by_year):
        rows = series.collect()
        assert len(rows) == len(want) and {(r.station_id, r.ts_utc): r.value for r in rows} == want
        assert all(r.year == int(r.ts_utc[:4]) and r.source == (K.SOURCE_BASE if r.year <= 2020 else K.SOURCE_PROJECTED) for r in rows)


def test_dealt_years_are_written_whole(spark):
    plan = _plan(spark)
    n = SY.days_by_year(plan)
    path = tempfile.mkdtemp(prefix="smogline-dealt-") + "/facts"
    S.write_facts_by_year(SY.daily_series(plan, WIN, 3, S.files_by_year(n)), path, dealt=True)
    back = spark.read.parquet(path).select("year", F.col("_metadata.file_path").alias("f")).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("f").alias("files")).collect()
    assert {r.year: r.n for r in back} == n and {r.files for r in back} == {1}
