"""Dashboard views and widgets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.dates import day, full_months, full_years, month_label, years_before
from rollcall.functions.measures import is_active, is_exited, mean, mean_of, quotient, rate
from rollcall.operators import headcount, salary
from rollcall.operators.ranking import top


def latest_compensation(compensation: DataFrame) -> DataFrame:
    return salary.latest(compensation)


def employee_360_flat(
    employees: DataFrame, compensation: DataFrame, performance: DataFrame, exits: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row per employee: newest pay, mean rating, tenure and exit."""
    pay = salary.latest(compensation).select("employee_id", "salary", "bonus", "stock")
    ratings = performance.groupBy("employee_id").agg(
        mean("rating", 2).alias("avg_performance_rating"), F.count("*").alias("reviews")
    )
    left = exits.select("employee_id", "exit_date", "exit_reason", F.col("voluntary").alias("voluntary_exit"))
    months = full_months(F.coalesce(F.col("exit_date"), day(as_of)), F.col("joining_date"))
    return (
        employees.join(pay, "employee_id", "left")
        .join(ratings, "employee_id", "left")
        .join(left, "employee_id", "left")
        .select(
            *employees.columns,
            "salary",
            "bonus",
            "stock",
            "avg_performance_rating",
            quotient(months, F.lit(12), 2).alias("tenure_years"),
            "exit_date",
            "exit_reason",
            "voluntary_exit",
            F.coalesce("reviews", F.lit(0)).alias("reviews"),
        )
    )


def employee_360(
    employees: DataFrame, compensation: DataFrame, performance: DataFrame, exits: DataFrame, as_of: dt.date
) -> DataFrame:
    """The flat view once per review, as the original view fans out.

    The mean rating is grouped before the join instead of windowed after it.
    Reviewed staff meet their reviews in an inner join, whose skewed keys can be
    split at run time on either side; the rest are appended.
    """
    flat = employee_360_flat(employees, compensation, performance, exits, as_of)
    reviewed = flat.join(performance.select("employee_id"), "employee_id")
    return reviewed.unionByName(flat.filter("reviews = 0")).drop("reviews")


def department_kpis(employees: DataFrame) -> DataFrame:
    return employees.groupBy("department").agg(
        F.count("*").alias("total_employees"),
        F.count_if(is_active()).alias("active"),
        F.count_if(is_exited()).alias("exited"),
        rate(is_exited()).alias("attrition_rate_pct"),
    )


def company_snapshot(employees: DataFrame, as_of: dt.date) -> DataFrame:
    years = full_years(day(as_of), F.col("joining_date"))
    return employees.agg(
        F.count("*").alias("total_employees"),
        F.count_if(is_active()).alias("active_employees"),
        F.count_if(is_exited()).alias("total_exits"),
        rate(is_exited()).alias("attrition_pct"),
        mean(F.when(is_active(), years), 2).alias("avg_tenure_active_yrs"),
    )


def department_grid(employees: DataFrame) -> DataFrame:
    return department_kpis(employees).orderBy(F.desc("attrition_rate_pct"), "department")


def rolling_exits(exits: DataFrame, as_of: dt.date, years: int = 2, fill_months: bool = False) -> DataFrame:
    """Exits per month with the sum over this and the 11 rows before.

    Rows, not months: a month without exits widens the span, unless
    ``fill_months`` adds it. The window runs over months, of which there are few.
    """
    recent = exits.filter(F.col("exit_date") >= years_before(as_of, years))
    months = recent.groupBy(F.trunc("exit_date", "month").alias("_month")).agg(F.count("*").alias("exits"))
    if fill_months:
        span = months.agg(F.min("_month").alias("a"), F.max("_month").alias("b"))
        spine = span.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("_month"))
        months = spine.join(months, "_month", "left").fillna(0, ["exits"])
    window = Window.orderBy("_month").rowsBetween(-11, 0)
    return (
        months.withColumn("rolling_12m_exits", F.sum("exits").over(window))
        .orderBy("_month")
        .select(F.date_format("_month", "MMM yyyy").alias("month"), "exits", "rolling_12m_exits")
    )


def rating_histogram(performance: DataFrame) -> DataFrame:
    return headcount.split(performance, "rating", "count").orderBy("rating")


def salary_vs_rating(employees: DataFrame, compensation: DataFrame, performance: DataFrame) -> DataFrame:
    """Mean newest salary and mean rating by department, from one grouping."""
    pay = salary.latest(compensation).select("employee_id", "salary")
    reviews = performance.groupBy("employee_id").agg(F.sum("rating").alias("_sum"), F.count("rating").alias("_n"))
    return (
        employees.select("employee_id", "department")
        .join(pay, "employee_id", "left")
        .join(reviews, "employee_id", "left")
        .groupBy("department")
        .agg(mean("salary", 0).alias("avg_salary"), mean_of(F.sum("_sum"), F.sum("_n"), 2).alias("avg_rating"))
        .filter("avg_salary IS NOT NULL AND avg_rating IS NOT NULL")
        .orderBy(F.desc("avg_salary"), "department")
    )


def promotion_rate(performance: DataFrame) -> DataFrame:
    return performance.agg(rate(F.col("promotion") == "Yes").alias("overall_promotion_rate_pct"))


def promotion_candidates(employees: DataFrame, performance: DataFrame, n: int = 10) -> DataFrame:
    """Active staff whose unrounded mean rating is 4 or more."""
    reviews = performance.groupBy("employee_id").agg(
        F.sum("rating").alias("_sum"),
        F.count("rating").alias("_n"),
        F.count("review_year").alias("years_reviewed"),
    )
    good = reviews.filter("_n > 0 AND _sum >= 4 * _n").withColumn("avg_rating", mean_of(F.col("_sum"), F.col("_n"), 2))
    staff = employees.filter(is_active()).select("employee_id", "department", "level", "location")
    return top(staff.join(good, "employee_id"), n, F.desc("avg_rating"), "employee_id").select(
        "employee_id", "department", "level", "location", "avg_rating", "years_reviewed"
    )


def learning_vs_attrition(employees: DataFrame, learning: DataFrame) -> DataFrame:
    """Departments with courses: mean hours per course and attrition rate."""
    hours = learning.groupBy("employee_id").agg(
        F.sum("hours_completed").alias("_hours"), F.count("hours_completed").alias("_timed"), F.count("*").alias("_rows")
    )
    return (
        employees.select("employee_id", "department", "status")
        .join(hours, "employee_id", "left")
        .groupBy("department")
        .agg(
            mean_of(F.sum("_hours"), F.sum("_timed"), 2).alias("avg_learning_hrs"),
            rate(is_exited()).alias("attrition_rate_pct"),
            F.sum("_rows").alias("_rows"),
        )
        .filter("_rows > 0")
        .drop("_rows")
        .orderBy("attrition_rate_pct", "department")
    )


def cumulative_hires(employees: DataFrame) -> DataFrame:
    """Hires per month with the running total over months."""
    months = employees.groupBy(F.trunc("joining_date", "month").alias("_month")).agg(F.count("*").alias("new_hires"))
    window = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, 0)
    return (
        months.withColumn("cumulative_hires", F.sum("new_hires").over(window))
        .orderBy("_month")
        .select(month_label(F.col("_month")).alias("hire_month"), "new_hires", "cumulative_hires")
    )


def views(
    employees: DataFrame, compensation: DataFrame, performance: DataFrame, exits: DataFrame, as_of: dt.date
) -> dict[str, DataFrame]:
    """The three reusable views, by name."""
    return {
        "vw_latest_compensation": latest_compensation(compensation),
        "vw_employee_360": employee_360(employees, compensation, performance, exits, as_of),
        "vw_dept_kpis": department_kpis(employees),
    }
