"""Retention: tenure, flight risk, underpaid performers, exits by month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.buckets import below
from rollcall.functions.dates import day, full_years, month_label, years_before
from rollcall.functions.measures import is_active, mean, rate
from rollcall.operators import salary

TENURE_BUCKETS = ((1, "< 1 year"), (3, "1–3 years"), (5, "3–5 years"), (10, "5–10 years"))


def _years(as_of: dt.date):
    return full_years(day(as_of), F.col("joining_date"))


def _mean_ratings(performance: DataFrame) -> DataFrame:
    return performance.groupBy("employee_id").agg(mean("rating", 2).alias("avg_rating"))


def mean_tenure(employees: DataFrame, as_of: dt.date) -> DataFrame:
    return employees.filter(is_active()).agg(mean(_years(as_of), 2).alias("avg_tenure_years"))


def mean_tenure_at_exit(exits: DataFrame, employees: DataFrame) -> DataFrame:
    years = full_years(F.col("exit_date"), F.col("joining_date"))
    return (
        exits.select("employee_id", "exit_date")
        .join(employees.select("employee_id", "joining_date"), "employee_id")
        .agg(mean(years, 2).alias("avg_tenure_before_exit_years"))
    )


def tenure_buckets(employees: DataFrame, as_of: dt.date) -> DataFrame:
    """Ordered by the shortest tenure in the bucket."""
    years = employees.filter(is_active()).select(_years(as_of).alias("_years"))
    return (
        years.groupBy(below(F.col("_years"), TENURE_BUCKETS, "10+ years").alias("tenure_bucket"))
        .agg(F.count("*").alias("employees"), F.min("_years").alias("_from"))
        .orderBy("_from")
        .select("tenure_bucket", "employees")
    )


def flight_risk(employees: DataFrame, performance: DataFrame, as_of: dt.date) -> DataFrame:
    """Active three years or more with a mean rating (rounded) below 3."""
    ratings = _mean_ratings(performance).filter("avg_rating < 3").select("employee_id", "avg_rating")
    staff = employees.filter(is_active()).select(
        "employee_id", "department", "level", "location", _years(as_of).cast("double").alias("tenure_years")
    )
    return (
        staff.filter("tenure_years >= 3")
        .join(ratings, "employee_id")
        .orderBy("avg_rating", F.desc("tenure_years"), "employee_id")
    )


def underpaid_performers(employees: DataFrame, compensation: DataFrame, performance: DataFrame) -> DataFrame:
    """Active, mean rating of 4 or more, paid below the 40th percentile of the level.

    Percentiles are over all staff; the filters come after.
    """
    ratings = _mean_ratings(performance).filter("avg_rating >= 4").select("employee_id", "avg_rating")
    low_paid = salary.percentiles(compensation, employees).filter("salary_percentile < 40")
    active = employees.filter(is_active()).select("employee_id")
    return (
        low_paid.join(active, "employee_id")
        .join(ratings, "employee_id")
        .select(
            "employee_id",
            "department",
            "level",
            "avg_rating",
            "salary",
            "salary_percentile",
            F.lit("HIGH RISK").alias("retention_flag"),
        )
        .orderBy(F.desc("avg_rating"), "salary_percentile", "employee_id")
    )


def by_department(employees: DataFrame) -> DataFrame:
    return (
        employees.groupBy("department")
        .agg(
            F.count("*").alias("ever_hired"),
            F.count_if(is_active()).alias("still_active"),
            rate(is_active()).alias("retention_rate_pct"),
        )
        .orderBy(F.desc("retention_rate_pct"), "department")
    )


def exits_by_month(exits: DataFrame, as_of: dt.date, years: int = 2) -> DataFrame:
    return (
        exits.filter(F.col("exit_date") >= years_before(as_of, years))
        .groupBy(month_label(F.col("exit_date")).alias("exit_month"))
        .agg(F.count("*").alias("exits"))
        .orderBy("exit_month")
    )
