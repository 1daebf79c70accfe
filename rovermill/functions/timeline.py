"""Time expressions: epoch doubles to whole microseconds, validity of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An epoch value above this is in milliseconds (1e11 s is the year 5138; 1e11 ms is 1973).
MS_FROM = 1e11


def finite(c: Column) -> Column:
    """True where a double is neither null, NaN nor infinite; never null."""
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def seconds(c: Column) -> Column:
    """Epoch seconds of a double that is in seconds or in milliseconds."""
    return F.when(F.abs(c) >= MS_FROM, c / F.lit(1000.0)).otherwise(c)


def micros(c: Column) -> Column:
    """Whole microseconds of epoch seconds or milliseconds; null where the value is missing or not finite."""
    return F.when(finite(c), F.floor(seconds(c) * F.lit(1e6) + F.lit(0.5)).cast("long"))
