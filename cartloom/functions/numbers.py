"""Small column functions on numbers and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Exact wall-clock seconds with six places, whatever the session's time zone."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def rounded(seconds: Column, places: int) -> Column:
    """A decimal rounded, halves up, as double."""
    return F.round(seconds, places).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Plain quotient; null instead of an error where the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def steady_mean(value: Column) -> Column:
    """Mean of amounts with up to six decimals, summed as decimals.

    Sums of doubles change in the last digits with the order in which tasks finish; these do not.
    """
    return F.avg(value.cast("decimal(20,6)")).cast("double")


def finite_or_zero(value: Column) -> Column:
    """0 in place of NaN, an infinity, or the null that `ratio` gives for a zero divisor."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)
