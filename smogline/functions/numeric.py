"""Numeric text parsing and NaN handling (ops B1, B7, B13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_from_text(c) -> Column:
    """Strip ``,`` thousands separators and read a double; bad text and text that
    reads as NaN -> NULL."""
    return nan_to_null(F.regexp_replace(F.trim(_c(c).cast("string")), ",", "").try_cast("double"))


def nan_to_null(c) -> Column:
    """NaN stands for NULL in the store; NaN also compares above every number in
    Spark, so this must run before any limit comparison."""
    return F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))


def is_finite(c) -> Column:
    x = _c(c)
    return (x < F.lit(float("inf"))) & (x > F.lit(float("-inf")))


def bround(c, digits: int) -> Column:
    """``F.bround`` of a double. It reads the number's decimal text, which decides only near a tie; elsewhere
    the whole number next to the scaled value is the same, and much cheaper."""
    x, scale = _c(c), F.lit(10.0 ** digits)
    scaled = x * scale
    whole = F.rint(scaled)
    clear = (F.abs(scaled) < 1e9) & (F.abs(F.abs(scaled - whole) - F.lit(0.5)) > 1e-6)
    return F.when(clear, whole / scale + F.lit(0.0)).otherwise(F.bround(x, digits))
