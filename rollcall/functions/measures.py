"""Counts, rates, shares and means.

A rate or mean is divided in DECIMAL from whole sums and rounded once, so its
last digit depends neither on task order nor on binary fractions.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def is_exited(status: str = "status") -> Column:
    return F.col(status) == "Exited"


def is_active(status: str = "status") -> Column:
    return F.col(status) == "Active"


def _whole(total: Column) -> Column:
    return total.cast("decimal(26,4)")


def quotient(num: Column, den: Column, digits: int, scale: int = 1, even: bool = False) -> Column:
    """``scale * num / den`` at ``digits`` places; NULL where ``den`` is 0.

    Half-up by default (SQL ROUND); ``even`` gives banker's rounding (pandas).
    """
    value = F.lit(Decimal(scale)) * num / F.nullif(den, F.lit(0))
    return (F.bround if even else F.round)(value, digits).cast("double")


def percent(num: Column, den: Column, digits: int = 2, even: bool = False) -> Column:
    return quotient(num.cast("bigint"), den.cast("bigint"), digits, 100, even)


def mean_of(total: Column, count: Column, digits: int, even: bool = False) -> Column:
    """Rounded mean from a finished sum and count."""
    return quotient(_whole(total), count, digits, 1, even)


def mean(col: str | Column, digits: int, even: bool = False) -> Column:
    """Rounded mean of a column, as an aggregate."""
    col = F.col(col) if isinstance(col, str) else col
    return mean_of(F.sum(col), F.count(col), digits, even)


def exact_mean(total: Column, count: Column) -> Column:
    """Unrounded mean of a finished whole sum, in DOUBLE."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def rate(cond: Column, digits: int = 2, even: bool = False) -> Column:
    """Percentage of rows that meet ``cond``, as an aggregate."""
    return percent(F.count_if(cond), F.count("*"), digits, even)


def with_share(groups: DataFrame, count: str, name: str, digits: int = 2, even: bool = False) -> DataFrame:
    """Share of each group in the total of ``count``.

    The total is a scalar subquery over the grouped rows, so no window pulls
    all groups into one task; the grouping exchange is reused.
    """
    total = groups.agg(F.sum(count).alias("_total")).scalar()
    return groups.withColumn(name, percent(F.col(count), total, digits, even))
