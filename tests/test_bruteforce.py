"""Spark operators against direct pandas computations on random data with a
hot series holding a third of the rows and duplicated keys."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from smogline.operators import cleaning as C
from smogline.operators import timeseries as TS


def _random_frame(seed=7, n=3000):
    rng = np.random.default_rng(seed)
    hot = n // 3
    station = np.concatenate([np.full(hot, 1), rng.integers(2, 40, n - hot)])
    pollutant = np.concatenate([np.full(hot, 0), rng.integers(0, 3, n - hot)])
    start = np.datetime64("2023-01-01T00:00:00")
    minutes = rng.integers(0, 60 * 24 * 400, n)  # duplicates of (series, ts) occur
    minutes[hot:hot + 50] = minutes[:50]
    ts = start + minutes.astype("timedelta64[m]")
    return pd.DataFrame({"station_id": station.astype("int32"),
                         "pollutant_id": np.array(["a", "b", "c"])[pollutant],
                         "ts_utc": ts.astype("datetime64[us]"),
                         "value": np.round(rng.uniform(0, 100, n), 2),
                         "pos": np.arange(n, dtype="int64")})


def _expected(pdf):
    last = pdf.sort_values("pos").drop_duplicates(["station_id", "pollutant_id", "ts_utc"], keep="last")
    last = last.sort_values(["station_id", "pollutant_id", "ts_utc"])
    g = last.groupby(["station_id", "pollutant_id"])
    dv = g["value"].diff()
    dt = g["ts_utc"].diff().dt.total_seconds() / 86400.0
    out = last.assign(rate=dv / dt).dropna(subset=["rate"])
    return sorted(zip(out.station_id.astype(int), out.pollutant_id, out.ts_utc.astype(str),
                      np.round(out.rate, 9)))


def test_dedupe_and_daily_derivative_match_pandas(spark):
    pdf = _random_frame()
    df = spark.createDataFrame(pdf).withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz"))
    clean = C.clean_measurements(df, ["pos"])
    assert clean.count() == len(pdf.drop_duplicates(["station_id", "pollutant_id", "ts_utc"]))
    expected = _expected(pdf)
    for chunk, per in (("month", None), ("day", None), ("auto", 100), ("auto", 7), ("auto", 10**6)):
        kw = {"rows_per_chunk": per} if per else {}
        got = sorted((int(r.station_id), r.pollutant_id, str(r.time), round(r.daily_rate, 9))
                     for r in TS.daily_derivative(clean, chunk=chunk, **kw).collect())
        assert got == expected, (chunk, per)


def test_yearly_stats_and_peaks_match_pandas(spark):
    pdf = _random_frame(seed=11)
    df = spark.createDataFrame(pdf).withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz"))
    clean = C.clean_measurements(df, ["pos"])
    last = pdf.sort_values("pos").drop_duplicates(["station_id", "pollutant_id", "ts_utc"], keep="last")
    last = last.assign(year=last.ts_utc.dt.year)
    exp = last.groupby(["year", "pollutant_id", "station_id"]).value.agg(["min", "max", "count"]).reset_index()
    got = {(r.year, r.pollutant_id, int(r.station_id)): (r.min_value, r.max_value, r.count_records)
           for r in TS.yearly_stats(clean).collect()}
    assert got == {(int(r.year), r.pollutant_id, int(r.station_id)): (r["min"], r["max"], r["count"])
                   for _, r in exp.iterrows()}
    peaks = {(r.year, r.pollutant_id, int(r.station_id)): str(r.peak_time) for r in TS.peaks_valleys(clean).collect()}
    srt = last.sort_values(["value", "ts_utc"], ascending=[False, True])
    first = srt.groupby(["year", "pollutant_id", "station_id"]).head(1)
    assert peaks == {(int(r.year), r.pollutant_id, int(r.station_id)): str(r.ts_utc) for _, r in first.iterrows()}
