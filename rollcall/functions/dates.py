"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.44


def day(as_of: dt.date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def full_months(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``.

    ``months_between`` is no substitute: it counts 29 Feb to 28 Feb of the next
    year as twelve months. Negative spans mirror positive ones.
    """

    def count(a: Column, b: Column) -> Column:
        months = (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
        return months - (F.dayofmonth(a) < F.dayofmonth(b)).cast("int")

    return F.when(later >= earlier, count(later, earlier)).otherwise(-count(earlier, later))


def full_years(later: Column, earlier: Column) -> Column:
    """Whole calendar years, truncated toward zero."""
    months = full_months(later, earlier)
    return ((months - months % 12) / 12).cast("int")


def tenure_months(end: Column, start: Column) -> Column:
    """Days over the mean month length, at two digits."""
    return F.bround(F.datediff(end, start) / F.lit(DAYS_PER_MONTH), 2)


def quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def years_before(as_of: dt.date | Column, years: int) -> Column:
    return F.add_months(day(as_of), -12 * years)


def lenient_date(c: Column) -> Column:
    """Date, or NULL where the text is none."""
    return c.try_cast("date")
