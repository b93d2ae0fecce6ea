"""Calendar parts, year modes and elapsed-time helpers (ops B15, E1, F1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EPOCH_YEAR_SECONDS


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_wall_clock(c) -> Column:
    """Timestamps are handled as UTC wall clock (``timestamp_ntz``)."""
    return _c(c).cast("timestamp_ntz")


def quarter(c) -> Column:
    return F.quarter(_c(c)).cast("int")


def month_number(c) -> Column:
    return F.month(_c(c)).cast("int")


def day_of_week_sunday0(c) -> Column:
    """Day of week with Sunday = 0 (Spark's ``dayofweek`` has Sunday = 1)."""
    return (F.dayofweek(_c(c)) - 1).cast("int")


def epoch_seconds(c) -> Column:
    return F.timestamp_diff("SECOND", _epoch(), as_wall_clock(c))


def year_of(c, mode: str = "calendar") -> Column:
    """Calendar year, or the 365-day epoch year the reference's stats query used
    (``seconds // 31,536,000 + 1970``), which drifts into the next year in late
    December."""
    if mode == "calendar":
        return F.year(_c(c)).cast("int")
    if mode == "epoch365":
        return (F.floor(epoch_seconds(c) / F.lit(EPOCH_YEAR_SECONDS)) + F.lit(1970)).cast("int")
    raise ValueError(f"unknown year mode {mode!r}")


def micros_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", as_wall_clock(start), as_wall_clock(end))


def days_between(start, end) -> Column:
    """Elapsed time in (fractional) days."""
    return micros_between(start, end).cast("double") / F.lit(86400e6)


def whole_days_between(start, end) -> Column:
    """Whole elapsed days, flooring partial days (not a date difference)."""
    return F.timestamp_diff("DAY", as_wall_clock(start), as_wall_clock(end))


def parse_iso_utc(c) -> Column:
    """ISO text ``YYYY-MM-DD[T ]HH:MM:SS[.f][Z or offset]`` -> UTC wall clock; an
    offset is applied, bad text -> NULL."""
    text = F.regexp_replace(F.trim(_c(c).cast("string")), "(?i)z$", "")
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(text.rlike(r"\d:\d{2}.*[+-]\d{1,2}(:?\d{2})?$"), instant).otherwise(text.try_cast("timestamp_ntz"))
