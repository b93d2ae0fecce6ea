"""Time-series analyses over the measurement fact.

Ops: E1 (yearly stats), E8 (monthly mean), F1 (daily derivative),
F2 (monthly derivative), F3 (peaks and valleys, with G4 folded in).
Series = (station_id, pollutant_id) ordered by ts_utc; input must already be
deduplicated on (station, pollutant, ts) (op B9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from .cleaning import time_range
from ..session import pin_table

SERIES = ["station_id", "pollutant_id"]


def _sid():
    return F.col("station_id").cast("string").alias("station_id")


def yearly_stats(df: DataFrame, year_mode: str = "calendar", start=None, stop=None) -> DataFrame:
    """min, max, avg, count per (year, pollutant, station) (op E1)."""
    df = time_range(df, start, stop)
    return (
        df.groupBy(cal.year_of("ts_utc", year_mode).alias("year"), "pollutant_id", _sid())
        .agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"),
             F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("count_records"))
    )


def peaks_valleys(df: DataFrame, start=None, stop=None) -> DataFrame:
    """Value and time of the max and the min per (calendar year, pollutant,
    station); ties go to the earliest time (ops F3, G4). One aggregate over one
    scan instead of two aggregates and a join."""
    df = time_range(df, start, stop)
    ts, v = F.col("ts_utc"), F.col("value")
    return (
        df.groupBy(cal.year_of("ts_utc").alias("year"), "pollutant_id", _sid())
        .agg(F.min_by(ts, F.struct((-v).alias("k"), ts.alias("t"))).alias("peak_time"),
             F.max(v).alias("peak_value"),
             F.min_by(ts, F.struct(v.alias("k"), ts.alias("t"))).alias("valley_time"),
             F.min(v).alias("valley_value"))
    )


def yearly_profile(df: DataFrame, start=None, stop=None) -> DataFrame:
    """E1 and F3 from one aggregate (same calendar-year grouping)."""
    df = time_range(df, start, stop)
    ts, v = F.col("ts_utc"), F.col("value")
    return (
        df.groupBy(cal.year_of("ts_utc").alias("year"), "pollutant_id", _sid())
        .agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"),
             F.avg(v).alias("avg_value"), F.count(F.lit(1)).alias("count_records"),
             F.min_by(ts, F.struct((-v).alias("k"), ts.alias("t"))).alias("peak_time"),
             F.min_by(ts, F.struct(v.alias("k"), ts.alias("t"))).alias("valley_time"))
    )


def monthly_mean(df: DataFrame, start=None, stop=None) -> DataFrame:
    """Mean per series and calendar month; empty months are absent (op E8)."""
    df = time_range(df, start, stop)
    return (
        df.groupBy(*SERIES, F.date_trunc("month", "ts_utc").cast("timestamp_ntz").alias("month_start"))
        .agg(F.avg("value").alias("mean_value"))
    )


ROWS_PER_CHUNK = 1_000_000


def _with_chunks(df: DataFrame, chunk: str, rows_per_chunk: int) -> DataFrame:
    """Add ``_chunk``: a calendar unit (``month``, ``day``, ...) or, for ``auto``, runs of
    at most ``rows_per_chunk`` rows in (series, time) order. Rows are range-partitioned and
    sorted once and written, so rows bound a chunk however dense a series is in time."""
    if chunk != "auto":
        return df.withColumn("_chunk", F.date_trunc(chunk, "ts_utc").cast("timestamp_ntz"))
    ordered = df.repartitionByRange(*SERIES, "ts_utc").sortWithinPartitions(*SERIES, "ts_utc")
    place = F.expr(f"monotonically_increasing_id() div {int(rows_per_chunk)}")
    return pin_table(ordered.withColumn("_chunk", place), "series_chunks")


def _rates(rows: DataFrame, window_keys: list[str], unit_days: float) -> DataFrame:
    w = Window.partitionBy(*window_keys).orderBy("ts_utc")
    prev_ts, prev_v = F.lag("ts_utc").over(w), F.lag("value").over(w)
    elapsed = cal.days_between(F.col("_pts"), F.col("ts_utc")) / F.lit(float(unit_days))
    return (
        rows.withColumn("_pts", prev_ts).withColumn("_pv", prev_v)
        .filter(~F.col("_marker") & F.col("_pts").isNotNull())
        .select(F.col("ts_utc").alias("time"),
                F.year("ts_utc").cast("int").alias("year"),
                F.month("ts_utc").cast("int").alias("month"),
                F.dayofmonth("ts_utc").cast("int").alias("day"),
                "pollutant_id", _sid(),
                ((F.col("value") - F.col("_pv")) / elapsed).alias("daily_rate"))
    )


def daily_derivative(df: DataFrame, unit_days: float = 1.0, chunk: str = "auto",
                     start=None, stop=None, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(v - v_prev) / elapsed-days per series; the first point of a series has
    none; negative rates are kept (op F1).

    Skew-safe: the window is partitioned by (series, chunk), so a series
    holding a third of all rows is spread over its chunks; ``auto`` cuts chunks of
    at most ``rows_per_chunk`` rows, bursts included. Each chunk's last point
    (a map-side combined aggregate, one row per series and chunk) is carried
    into the next non-empty chunk as a marker row, so one window pass sees
    every predecessor; markers are dropped afterwards. No join of the fact with
    itself."""
    points = time_range(df, start, stop).select(*SERIES, "ts_utc", "value")
    base = _with_chunks(points, chunk, rows_per_chunk)
    last = (base.groupBy(*SERIES, "_chunk")
            .agg(F.max_by(F.struct("ts_utc", "value"), F.col("ts_utc")).alias("_last")))
    nxt = F.lead("_chunk").over(Window.partitionBy(*SERIES).orderBy("_chunk"))
    carry = (last.withColumn("_next", nxt).filter(F.col("_next").isNotNull())
             .select(*SERIES, F.col("_last.ts_utc").alias("ts_utc"), F.col("_last.value").alias("value"),
                     F.col("_next").alias("_chunk"), F.lit(True).alias("_marker")))
    rows = base.withColumn("_marker", F.lit(False)).unionByName(carry)
    return _rates(rows, [*SERIES, "_chunk"], unit_days)


def monthly_derivative(df: DataFrame, start=None, stop=None) -> DataFrame:
    """E8 then the change per calendar month between consecutive non-empty
    months (op F2). ``time`` is the window stop (next month start, clipped to
    ``stop``) as the reference labels it; ``month_start`` is the bucket."""
    mm = monthly_mean(df, start, stop)
    w = Window.partitionBy(*SERIES).orderBy("month_start")
    idx = F.year("month_start") * 12 + F.month("month_start")
    prev_idx = F.lag(idx).over(w)
    rate = (F.col("mean_value") - F.lag("mean_value").over(w)) / (idx - prev_idx).cast("double")
    label = F.add_months(F.col("month_start"), 1).cast("timestamp_ntz")
    if stop is not None:
        label = F.least(label, F.lit(stop).cast("timestamp_ntz"))
    out = mm.select(*SERIES, "month_start", label.alias("time"), rate.alias("monthly_rate"))
    return out.filter(F.col("monthly_rate").isNotNull()).select(
        "time", F.year("time").cast("int").alias("year"), F.month("time").cast("int").alias("month"),
        "pollutant_id", _sid(), "monthly_rate", "month_start")
