"""Calendar rules for monthly periods written as yyyymm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from satmart.functions.text import is_six_digits

# Month names as the time dimension shows them.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def period_start(period: Column) -> Column:
    """First day of a yyyymm text; null for any other text or month."""
    text = F.when(is_six_digits(period), F.concat(period, F.lit("01")))
    return F.try_to_date(text, "yyyyMMdd")


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), month)


def semester(month: Column) -> Column:
    return F.when(month > 6, 2).otherwise(1)


def month_number(day: Column) -> Column:
    """Months on one real-time axis, so gaps keep their length."""
    return (F.year(day) - 2000) * 12 + F.month(day)


def month_range(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.make_interval(months=F.lit(1)))
