"""Trends and daily-series generation (ops D1-D14).

The whole generator is one plan: capabilities (a catalogue) are joined with
their means and trends, repartitioned so every task generates a bounded slice, then
made into days. Randomness comes from hashes of (station, pollutant, date), so
retried tasks reproduce their rows.
"""

from __future__ import annotations

import math
import datetime as _dt
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import hashing as H
from ..functions.numeric import bround
from ..session import pin_table
from ..sources.base_csv import COMPACT_N, COMPACT_SUM, station_key
from ..sources.sinks import file_places


@dataclass(frozen=True)
class Window_:
    start_year: int
    end_year: int
    base_data_end: int
    end_date: str  # last generated day in end_year (ISO date)

    def __post_init__(self):
        last = _dt.date.fromisoformat(self.end_date)
        if self.start_year > self.end_year or self.base_data_end > self.end_year:
            raise ValueError("the generator's start and base data must not lie after its end year")
        if last.year != self.end_year:
            raise ValueError("the last generated day must lie in the end year")


def _keyed(base: DataFrame, spark_codes: DataFrame) -> DataFrame:
    b = base.select(station_key("station_raw").alias("station_key"), F.trim("variable").alias("variable"),
                    "year", "value")
    return b.join(F.broadcast(spark_codes.select("variable", "pollutant_id")), "variable", "inner")


def series_sums(base: DataFrame, codes: DataFrame) -> DataFrame:
    """Sum and count of the values per (station, pollutant, year): the one
    aggregate over the rows that D1, D2 and the capability pairs (C4) all
    derive from, so the base is scanned once for the three of them. ``base``
    is typed rows or their ``compact_rows`` form (sums and counts already)."""
    compact = COMPACT_SUM in base.columns
    vals = [COMPACT_SUM, COMPACT_N] if compact else ["value"]
    b = base.select(station_key("station_raw").alias("station_key"), F.trim("variable").alias("variable"),
                    "year", *vals)
    b = b.join(F.broadcast(codes.select("variable", "pollutant_id")), "variable", "inner")
    aggs = ([F.sum(COMPACT_SUM).alias("v_sum"), F.sum(COMPACT_N).alias("v_n")] if compact
            else [F.sum("value").alias("v_sum"), F.count("value").alias("v_n")])
    return b.groupBy("station_key", "pollutant_id", "year").agg(*aggs)


def raw_means_from(sums: DataFrame) -> DataFrame:
    """Op D1 from ``series_sums``: the mean over raw rows is the sum of the
    yearly sums over the sum of the yearly counts."""
    return sums.groupBy("station_key", "pollutant_id").agg(
        F.try_divide(F.sum("v_sum"), F.sum("v_n")).alias("annual_mean"))


def yearly_means_from(sums: DataFrame) -> DataFrame:
    """Op D2 from ``series_sums``."""
    return sums.select("station_key", "pollutant_id", "year",
                       F.try_divide(F.col("v_sum"), F.col("v_n")).alias("year_mean"))


def raw_means(base: DataFrame, codes: DataFrame) -> DataFrame:
    """Mean over raw rows per (station, pollutant) (op D1)."""
    return _keyed(base, codes).groupBy("station_key", "pollutant_id").agg(F.avg("value").alias("annual_mean"))


def yearly_means(base: DataFrame, codes: DataFrame) -> DataFrame:
    """Mean per (station, pollutant, year) (op D2)."""
    return (_keyed(base, codes).groupBy("station_key", "pollutant_id", "year")
            .agg(F.avg("value").alias("year_mean")))


def trends(yearly: DataFrame) -> DataFrame:
    """Relative trend per (station, pollutant) (op D3): at least 3 yearly means
    with population std > 0; least-squares slope over the years divided by the
    mean of the yearly means (0 when that mean <= 0), clipped to +/-0.1."""
    g = yearly.groupBy("station_key", "pollutant_id").agg(
        F.count(F.lit(1)).alias("n_years"),
        F.regr_slope("year_mean", "year").alias("slope"),
        F.avg("year_mean").alias("mean_of_means"),
        F.stddev_pop("year_mean").alias("sd"))
    g = g.filter((F.col("n_years") >= 3) & (F.col("sd") > 0))
    rel = F.when(F.col("mean_of_means") > 0, F.col("slope") / F.col("mean_of_means")).otherwise(F.lit(0.0))
    clip = F.greatest(F.least(rel, F.lit(K.TREND_CLIP)), F.lit(-K.TREND_CLIP))
    return g.select("station_key", "pollutant_id", clip.alias("trend"))


def series_plan(caps: DataFrame, stations_df: DataFrame, means: DataFrame, trend_df: DataFrame,
                win: Window_) -> DataFrame:
    """One row per capability with its mean (D4 default), trend and coverage
    window (D5). Catalogue-size. The mean is kept to 6 and the trend to 9 digits, so
    that the order in which a distributed sum adds up never changes a generated day."""
    st = stations_df.select("station_id", F.regexp_replace("station_code", "^ST-", "").alias("station_key"),
                            "years_min", "years_max")
    p = caps.join(st, "station_id", "inner")
    p = p.join(means, ["station_key", "pollutant_id"], "left").join(trend_df, ["station_key", "pollutant_id"], "left")
    default = F.when(F.col("pollutant_id") == "co", F.lit(K.DEFAULT_MEAN_CO)).otherwise(F.lit(K.DEFAULT_MEAN))
    start_y = F.greatest(F.lit(win.start_year), F.col("years_min"))
    end_y = F.when(F.col("years_max") >= win.base_data_end, F.lit(win.end_year)) \
             .otherwise(F.least(F.lit(win.end_year), F.col("years_max")))
    p = p.select("station_id", "pollutant_id", "unit",
                 F.round(F.coalesce("annual_mean", default), 6).alias("annual_mean"),
                 F.round(F.coalesce("trend", F.lit(0.0)), 9).alias("trend"),
                 start_y.cast("int").alias("start_year"), end_y.cast("int").alias("end_year"))
    first_day = F.make_date(F.col("start_year"), F.lit(1), F.lit(1))
    last_day = F.when(F.col("end_year") == win.end_year, F.lit(win.end_date).cast("date")) \
                .otherwise(F.make_date(F.col("end_year"), F.lit(12), F.lit(31)))
    return p.withColumn("first_day", first_day).withColumn("last_day", last_day) \
            .withColumn("is_extended", F.col("end_year") > win.base_data_end) \
            .filter(F.col("first_day") <= F.col("last_day"))


ROWS_PER_TASK = 1_000_000


def generator_partitions(plan: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for the exploded series: total generated days / rows per task,
    at least the session's parallelism (one small aggregate over the plan)."""
    total = plan.agg(F.sum(F.datediff("last_day", "first_day") + 1).alias("n")).first()["n"] or 0
    cores = plan.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-int(total) // rows_per_task))


def _years_of(plan: DataFrame) -> DataFrame:
    """The plan's windows cut into calendar years: ``year``, ``from_day``, ``to_day``."""
    y = plan.withColumn("year", F.explode(F.sequence(F.year("first_day"), F.year("last_day"))))
    return y.withColumns({"from_day": F.greatest("first_day", F.make_date("year", F.lit(1), F.lit(1))),
                          "to_day": F.least("last_day", F.make_date("year", F.lit(12), F.lit(31)))})


def days_by_year(plan: DataFrame) -> dict[int, int]:
    """Rows that the generator will make for each year, from the plan's windows: a row for each year."""
    n = F.sum(F.datediff("to_day", "from_day") + 1).alias("n")
    return {r["year"]: r["n"] for r in _years_of(plan).groupBy("year").agg(n).collect()}


def with_spikes(days: DataFrame) -> DataFrame:
    """Add ``_spike``: a U(1.5, 2.5) factor on exactly floor(2% of the series'
    days) days chosen by hash rank, 1.0 elsewhere (op D11), for days that are given as
    rows; ``drawn_days`` makes the same choice while it makes the days. One series
    is at most the calendar span in days, so its window partition is bounded."""
    key = ("station_id", "pollutant_id", "d")
    series = Window.partitionBy("station_id", "pollutant_id")
    rank = F.row_number().over(series.orderBy(H.uniform01(*key, salt="spike"), F.col("d")))
    n_days = F.datediff("last_day", "first_day") + 1
    spike = F.when(rank <= F.floor(n_days * F.lit(K.SPIKE_FRACTION)),
                   H.uniform(K.SPIKE_LOW, K.SPIKE_HIGH, *key, salt="spike_size")).otherwise(F.lit(1.0))
    return days.withColumn("_spike", spike)


#: Days that are hashed at once: arrays of this length stay in a core's cache.
DAYS_AT_ONCE = 32_768


class _Calendar:
    """The days between the ends of a batch of spans: their texts, to be hashed after a series' key, and what is the
    same for every series on a day: its season (op D9) and the effect of its weekday (op D10)."""

    def __init__(self, first: int, last: int):
        self.first = first
        self.numbers = np.arange(first, last + 1)
        days = self.numbers.astype("datetime64[D]")
        self.keys = H.JoinedHashes([t.encode() for t in np.datetime_as_string(days).tolist()])
        self.stamps = np.array([t + b"T00:00:00Z" for t in self.keys.texts])
        day_of_year = (days - days.astype("datetime64[Y]").astype("datetime64[D]")).astype(np.int64) + 1
        self.season = np.sin(2 * math.pi * day_of_year.astype(float) / K.SEASON_PERIOD)
        monday_0 = (self.numbers + 3) % 7  # day 0 was a Thursday
        self.week = np.where(monday_0 >= 5, K.WEEKEND_EFFECT, K.WEEKDAY_EFFECT)


def _lots(batch: pa.RecordBatch, first: str, last: str):
    """The calendar of a batch of spans, and slices of the batch of about ``DAYS_AT_ONCE`` days (one span at
    least), each with its series' keys, the spans' first days (as numbers) and numbers of days."""
    if not batch.num_rows:
        return
    starts, ends = (batch.column(c).cast(pa.int32()).to_numpy().astype(np.int64) for c in (first, last))
    calendar, counts = _Calendar(int(starts.min()), int(ends.max())), ends - starts + 1
    heads = [h.encode() for h in batch.column("_head").to_pylist()]
    total, at = np.cumsum(counts), 0
    while at < len(counts):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + DAYS_AT_ONCE, side="right")))
        yield calendar, batch.slice(at, to - at), heads[at:to], starts[at:to], counts[at:to]
        at = to


def _spike_ranks(calendar: _Calendar, heads: list[bytes], starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return H.top_bits(calendar.keys.md5(heads, _places(calendar, starts, counts), counts, "spike"))


def _places(calendar: _Calendar, starts: np.ndarray, counts: np.ndarray) -> list[slice]:
    return [slice(at, at + n) for at, n in zip((starts - calendar.first).tolist(), counts.tolist())]


def _cuts(ranks: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last spike of each whole series in hash order: its hash (-1: no day spikes) and day."""
    hashes, days, at = np.full(len(counts), -1), np.zeros(len(counts), np.int64), 0
    for i, n in enumerate(counts):
        spikes = math.floor(n * K.SPIKE_FRACTION)
        if spikes:
            last = np.argsort(ranks[at:at + n], kind="stable")[spikes - 1]
            hashes[i], days[i] = ranks[at + last], starts[i] + last
        at += n
    return hashes, days


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for calendar, lot, heads, starts, counts in _lots(batch, "first_day", "last_day"):
            hashes, days = _cuts(_spike_ranks(calendar, heads, starts, counts), starts, counts)
            yield pa.RecordBatch.from_arrays([*lot.columns, pa.array(hashes), pa.array(days)],
                                             names=[*lot.schema.names, "_cut_hash", "_cut_day"])


def with_spike_cuts(series: DataFrame) -> DataFrame:
    """Add the last spike of each series in hash order, ``_cut_hash`` and ``_cut_day`` (op D11): the days whose (hash,
    day) is not beyond it are the floor(2%) that spike. So any stretch of a series can be made alone."""
    cut = [T.StructField(c, T.LongType()) for c in ("_cut_hash", "_cut_day")]
    return series.mapInArrow(_cut_batches, T.StructType([*series.schema.fields, *cut]))


_SERIES = ["station_id", "pollutant_id", "unit"]


def _values(lot: pa.RecordBatch, span: np.ndarray, calendar: _Calendar, days: np.ndarray, noise: np.ndarray,
            base_end: int) -> np.ndarray:
    """Each day's value before its spike (ops D6-D10), in the order of operations of the SQL form."""
    mean, trend = (lot.column(c).to_numpy(zero_copy_only=False) for c in ("annual_mean", "trend"))
    extended = lot.column("is_extended").to_numpy(zero_copy_only=False).astype(bool)
    weekly = np.isin(lot.column("pollutant_id").to_numpy(zero_copy_only=False), K.WEEKLY_POLLUTANTS)
    m, adj = mean[span], mean[span]
    projected = np.flatnonzero((extended & (trend != 0))[span])
    years_from_base = ((calendar.numbers - base_end) / K.DAYS_PER_YEAR)[days[projected]]
    adj[projected] *= np.power((1.0 + trend)[span[projected]], years_from_base)
    season = K.SEASONAL_AMPLITUDE * m * calendar.season[days]
    return adj + K.NOISE_SD_FRACTION * adj * noise + season + np.where(weekly[span], calendar.week[days] * adj, 0.0)


def _day_batches(batches: Iterator[pa.RecordBatch], base_end: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for calendar, lot, heads, starts, counts in _lots(batch, "from_day", "to_day"):
            keys, places = calendar.keys, _places(calendar, starts, counts)
            span = np.repeat(np.arange(len(counts)), counts)
            days = np.concatenate([np.arange(p.start, p.stop) for p in places])  # from the calendar's first
            noise = H.normals(keys.md5(heads, places, counts, "noise"))
            value = _values(lot, span, calendar, days, noise, base_end)
            ranks = _spike_ranks(calendar, heads, starts, counts)
            cut, cut_day = (lot.column("_cut_hash").to_numpy(), lot.column("_cut_day").to_numpy()) \
                if "_cut_hash" in lot.schema.names else _cuts(ranks, starts, counts)
            spikes = np.flatnonzero(ranks <= cut[span])
            spikes = spikes[(ranks[spikes] < cut[span[spikes]]) | (days[spikes] + calendar.first <= cut_day[span[spikes]])]
            of_span = np.bincount(span[spikes], minlength=len(counts))
            sizes = keys.md5(heads, np.split(days[spikes], np.cumsum(of_span)[:-1]), of_span, "spike_size")
            value[spikes] *= K.SPIKE_LOW + (K.SPIKE_HIGH - K.SPIKE_LOW) * H.units(sizes)
            stamps = calendar.stamps[days]
            bounds = np.arange(0, stamps.nbytes + 1, stamps.itemsize, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*lot.select(_SERIES).take(pa.array(span)).columns, pa.array(calendar.numbers[days].astype(np.int32)).cast(pa.date32()),
                 pa.StringArray.from_buffers(len(days), pa.py_buffer(bounds), pa.py_buffer(stamps)), pa.array(value)],
                names=[*_SERIES, "d", "ts_utc", "v"])


def drawn_days(spans: DataFrame, win: Window_) -> DataFrame:
    """A row for each day from ``from_day`` to ``to_day`` of each span, which is a whole series or, after
    ``with_spike_cuts``, a stretch of one, with the day's value ``v`` before it is rounded: trend, noise, season, week
    and spikes (ops D6-D11). The hashes are those of ``functions.hashing``, made for many days at once; no window
    sorts the days."""
    base_end = (_dt.date(win.base_data_end, 12, 31) - _dt.date(1970, 1, 1)).days
    schema = T.StructType([*(spans.schema[c] for c in _SERIES), T.StructField("d", T.DateType()),
                           T.StructField("ts_utc", T.StringType()), T.StructField("v", T.DoubleType())])
    return spans.mapInArrow(lambda batches: _day_batches(batches, base_end), schema)


def daily_series(plan: DataFrame, win: Window_, partitions: int | None = None,
                 files: dict[int, int] | None = None) -> DataFrame:
    """Capabilities x days -> measurements (ops D6-D13, composed as D14).

    With ``files`` (files of each year, ``sinks.files_by_year``) the series are cut into years and dealt to the files
    before their days are made, so that ``sinks.write_facts_by_year`` can write them as they come
    (``dealt``): the plan is shuffled, the days never are."""
    # One series is at most the calendar span in days (bounded, never skewed by
    # data volume), so series are the unit of parallelism. The count is explicit
    # (sized from the rows to be generated) because the plan itself is tiny and AQE
    # would otherwise coalesce it into a single task before the days are made.
    if partitions is None:
        # The plan is read twice (sizing, then generation): write it once to the
        # shared checkpoint folder. It is catalogue-size, and the cut also means
        # a lost generator task never recomputes the catalogue derivation.
        plan = pin_table(plan, "series_plan")
        partitions = generator_partitions(plan)
    head = F.concat_ws("|", F.col("station_id").cast("string"), F.col("pollutant_id"), F.lit(""))
    spans = (plan.filter(F.col("first_day") <= F.col("last_day")).withColumn("_head", head)
             .repartition(partitions, "station_id", "pollutant_id"))
    if files is None:
        spans = spans.withColumns({"from_day": F.col("first_day"), "to_day": F.col("last_day")})
    else:
        spans = _years_of(with_spike_cuts(spans)).repartitionById(*file_places(files, "station_id", "pollutant_id"))
    v = drawn_days(spans, win)
    digits = F.when(F.col("pollutant_id") == "co", F.lit(1)).otherwise(F.lit(2))
    clamped = F.greatest(F.col("v"), F.lit(0.0))
    value = F.when(digits == 1, bround(clamped, 1)).otherwise(bround(clamped, 2))
    year = F.year("d")
    return v.select(
        "station_id", "pollutant_id",
        "ts_utc",
        value.alias("value"), "unit",
        F.when(year <= win.base_data_end, F.lit(K.SOURCE_BASE)).otherwise(F.lit(K.SOURCE_PROJECTED)).alias("source"),
        year.cast("int").alias("year"),
    )
