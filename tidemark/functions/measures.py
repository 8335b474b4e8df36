"""Small aggregate and ratio expressions.

Ratios go through decimals wide enough that rounding half up is exact for
counts up to 10^15; doubles would round ties by accident.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition) -> Column:
    return F.count_if(condition)


def flag(condition) -> Column:
    return F.when(condition, 1).otherwise(0)


def _whole(count) -> Column:
    return F.nullif(count, F.lit(0)).cast("decimal(15,0)")


def percent(part, whole, digits: int = 2) -> Column:
    """100 · part / whole, NULL for a zero whole."""
    return F.round((part * F.lit(100)).cast("decimal(18,0)") / _whole(whole), digits).cast("double")


def ratio(part, whole, digits: int) -> Column:
    """part / whole, rounded; NULL for a zero whole."""
    return F.round(part.cast("decimal(22,2)") / _whole(whole), digits).cast("double")


def mean(value, digits: int) -> Column:
    """Average of the non-null values, rounded; NULL when there are none."""
    return ratio(F.sum(value), F.count(value), digits)


def total(value, digits: int = 2) -> Column:
    return F.round(F.sum(value), digits).cast("double")


def settled(value, digits: int) -> Column:
    """A double rounded after its last-bit noise is cut off at six digits."""
    return F.round(value.cast("decimal(24,6)"), digits).cast("double")
