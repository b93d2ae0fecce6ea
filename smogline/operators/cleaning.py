"""Measurement cleaning, deduplication and the cleaning report.

Ops: B2, B5-B11, B16, B20-B24. Rules apply in order and each rejected row is
counted once, under the first rule it fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.numeric import is_finite

NATURAL_KEY = ["station_id", "pollutant_id", "ts_utc"]

# Reject reasons, in rule order.
R_NULL, R_NEGATIVE, R_NON_FINITE, R_BAD_TS = "null", "negative", "non_finite", "bad_timestamp"


def _parsed_ts(df: DataFrame, ts_col: str) -> Column:
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, T.StringType):
        return cal.parse_iso_utc(ts_col)
    return cal.as_wall_clock(ts_col)


def tag_rejects(raw: DataFrame, ts_col: str = "ts_utc") -> DataFrame:
    """Add ``reject`` (NULL when the row passes) and a parsed ``ts_utc``.

    null (NaN, and text that is no number, count as null) -> negative -> non-finite ->
    bad timestamp."""
    v = F.col("value").try_cast("double")
    nullish = (F.col("station_id").isNull() | F.col("pollutant_id").isNull()
               | F.col(ts_col).isNull() | v.isNull() | F.isnan(v))
    parsed = _parsed_ts(raw, ts_col)
    reject = (F.when(nullish, F.lit(R_NULL))
              .when(v < 0, F.lit(R_NEGATIVE))
              .when(~is_finite(v), F.lit(R_NON_FINITE))
              .when(parsed.isNull(), F.lit(R_BAD_TS)))
    # Tag first: the rules read the input columns, not their cleaned forms.
    return raw.withColumn("reject", reject).withColumn("value", v).withColumn(ts_col, parsed)


def drop_rejects(raw: DataFrame, ts_col: str = "ts_utc") -> DataFrame:
    """Ops B5-B8 as one filter."""
    return tag_rejects(raw, ts_col).filter(F.col("reject").isNull()).drop("reject")


def keep_one(df: DataFrame, keys: list[str], order_cols: list[str], last: bool = True) -> DataFrame:
    """One row per key: the last (or first) in ``order_cols`` order (ops B9, B21).

    An aggregate, not a window: ``max_by`` is combined map-side, so a key that
    holds a third of the rows is reduced before the shuffle. Whole-number order columns
    are packed into one number; if all others have a fixed width, each is picked on its
    own, in a hash aggregate without a sort. Otherwise structs are compared, in a sort
    aggregate: select the columns that are needed first."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    packed = _packed_order(df, order_cols)
    if packed is not None and all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in rest):
        # every aggregate sees the same rows in the same order, so all take the same row
        return df.groupBy(*keys).agg(*[pick(F.col(c), packed).alias(c) for c in rest])
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(pick(payload, order).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))


_WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_FIXED_WIDTH = (T.BooleanType, *_WHOLE_BITS, T.FloatType, T.DoubleType, T.DecimalType,
                T.DateType, T.TimestampType, T.TimestampNTZType)


def _packed_order(df: DataFrame, order_cols: list[str]) -> Column | None:
    """One number that sorts as the whole-number ``order_cols`` do, nulls first; None if they don't fit."""
    bits = [_WHOLE_BITS.get(type(df.schema[c].dataType)) for c in order_cols]
    if not bits or None in bits or sum(b + 1 for b in bits) > 126:
        return None
    out = None
    for c, b in zip(order_cols, bits):
        value = F.col(c).cast("decimal(20,0)") + F.lit(str(2 ** (b - 1) + 1)).cast("decimal(20,0)")
        value = F.coalesce(value, F.lit(0)).cast("decimal(38,0)")
        out = value if out is None else (
            (out * F.lit(str(2 ** b + 1)).cast("decimal(20,0)")).cast("decimal(38,0)") + value).cast("decimal(38,0)")
    return out


def clean_measurements(raw: DataFrame, order_cols: list[str], keys: list[str] = NATURAL_KEY,
                       ts_col: str = "ts_utc", drop_order: bool = True,
                       sort_by_time: bool = False) -> DataFrame:
    """Drop null/NaN, negative, non-finite and unparsable rows, then keep
    the last row per (station, pollutant, ts) in input order; typed output.
    ``sort_by_time`` orders each partition by time for a time-clustered write
    (a global sort would add a range shuffle for no gain)."""
    ok = drop_rejects(raw, ts_col)
    out = keep_one(ok, keys, order_cols, last=True)
    out = out.withColumn("station_id", F.col("station_id").cast("int")) \
             .withColumn("value", F.col("value").cast("double"))
    if drop_order:
        out = out.drop(*order_cols)
    if sort_by_time:
        out = out.sortWithinPartitions(ts_col)
    return out


def cleaning_report(raw: DataFrame, keys: list[str] = NATURAL_KEY, ts_col: str = "ts_utc") -> DataFrame:
    """One-row report: initial, nulls, negatives, non-finite, bad timestamps,
    duplicates, final, removed % (op B11). Two aggregates, no join: rejected rows
    collapse to their reason, kept rows to their natural key."""
    tagged = tag_rejects(raw, ts_col)
    kept = F.col("reject").isNull()
    grouped = tagged.groupBy(
        "reject", *[F.when(kept, F.col(k)).alias(k) for k in keys]
    ).agg(F.count(F.lit(1)).alias("n"))

    def by_reason(r):
        return F.coalesce(F.sum(F.when(F.col("reject") == r, F.col("n"))), F.lit(0)).cast("bigint")

    kept_g = F.col("reject").isNull()
    rep = grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("initial_count"),
        by_reason(R_NULL).alias("nulls_removed"),
        by_reason(R_NEGATIVE).alias("negative_values"),
        by_reason(R_NON_FINITE).alias("non_finite_values"),
        by_reason(R_BAD_TS).alias("invalid_timestamps"),
        F.coalesce(F.sum(F.when(kept_g, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("duplicates_removed"),
        F.count_if(kept_g).cast("bigint").alias("final_count"),
    )
    return rep.withColumn(
        "removed_pct",
        F.when(F.col("initial_count") > 0,
               F.round((F.col("initial_count") - F.col("final_count")) * F.lit(100.0) / F.col("initial_count"), 2))
        .otherwise(F.lit(0.0)),
    )


def drop_null_keys(df: DataFrame, keys=("pollutant_id", "station_id")) -> DataFrame:
    """Op B16."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def fail_on_null_key(df: DataFrame, key: str = "pollutant_id") -> DataFrame:
    """Op B20: the plan raises at run time if any key is NULL (no driver round trip)."""
    return df.withColumn(
        key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null {key} in input")).cast("string"))
        .otherwise(F.col(key)))


def time_range(df: DataFrame, start=None, stop=None, ts_col: str = "ts_utc") -> DataFrame:
    """Half-open ``[start, stop)`` (op B22)."""
    if start is not None:
        df = df.filter(F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
    if stop is not None:
        df = df.filter(F.col(ts_col) < F.lit(stop).cast("timestamp_ntz"))
    return year_bounds(df, start, stop)


def year_bounds(df: DataFrame, start=None, stop=None, col: str = "year") -> DataFrame:
    """The calendar years of ``[start, stop]`` on a store partitioned by year, so that the scan
    skips the other partitions; a frame without the column is left as it is. Every filter on a time
    range goes through here: batch ranges, extracts, pending rows and the export stream."""
    if col not in df.columns:
        return df
    if start is not None:
        df = df.filter(F.col(col) >= F.year(F.lit(start).cast("timestamp_ntz")))
    if stop is not None:
        df = df.filter(F.col(col) <= F.year(F.lit(stop).cast("timestamp_ntz")))
    return df


def closed_range(df: DataFrame, start, end, ts_col: str = "ts_utc") -> DataFrame:
    """``BETWEEN start AND end``; a date end means midnight, so later rows that day are out (op B23)."""
    return year_bounds(df.filter(F.col(ts_col).between(F.lit(start).cast("timestamp_ntz"),
                                                       F.lit(end).cast("timestamp_ntz"))), start, end)
