"""Guarded ratios and differences of two rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratesmith.rules import tables as T


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.when(F.coalesce(b, F.lit(0.0)) != 0, a / b).otherwise(F.lit(0.0))


def relative_difference(a: Column, b: Column) -> Column:
    """The difference over the lower of the two, 0 where that is 0."""
    return ratio(F.abs(b - a), F.least(a, b))


def material(a: Column, b: Column) -> Column:
    return relative_difference(a, b) >= T.MATERIAL


def implausible(a: Column, b: Column) -> Column:
    return ratio(F.greatest(a, b), F.least(a, b)) >= T.IMPLAUSIBLE


def days_apart(a: Column, b: Column) -> Column:
    """Null if a side is missing."""
    return F.abs(F.datediff(a, b))


def drift_explains(a: Column, b: Column, days: Column) -> Column:
    """Whether the difference over that many days is within the yearly drift that is plausible."""
    return F.coalesce((days != 0) & (ratio(relative_difference(a, b), days / 365.0) <= T.ANNUAL_DRIFT), F.lit(False))


def half_even(c: Column, places: int = 0) -> Column:
    return F.bround(c, places)
