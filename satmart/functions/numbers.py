"""Numeric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = r"\A[+-]?[0-9]+\z"
_NUMBER = r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def lenient_long(c: Column) -> Column:
    """A number in text, truncated to a whole number; anything else is null.

    The pattern keeps out what the cast alone would accept, such as '1d', 'NaN' or 'Infinity'.
    Whole numbers never pass through floating point, so they stay exact.
    """
    rounded = F.when(c.rlike(_NUMBER), c.try_cast("double").try_cast("bigint"))
    return F.when(c.rlike(_WHOLE), c.try_cast("bigint")).otherwise(rounded)


def half_even(c: Column, places: int = 0) -> Column:
    return F.bround(c, places)


def whole_not_negative(c: Column) -> Column:
    """Rounded to a whole number, half to even, and never under zero."""
    return F.greatest(F.bround(c, 0), F.lit(0.0)).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """part / whole x 100; null for a zero or missing whole."""
    return F.try_divide(part, whole) * 100
