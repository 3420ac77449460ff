"""Salary: levels, departments, pay gap, latest pay, percentiles, bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import mean, mean_of, quotient
from rollcall.functions.picks import newest
from rollcall.operators.ranking import global_ntile, previous_value, value_ranks
from rollcall.sources.scratch import written


def by_level(compensation: DataFrame) -> DataFrame:
    return (
        compensation.groupBy("level")
        .agg(
            mean("salary", 0).alias("avg_salary"),
            F.round(F.min("salary"), 0).cast("double").alias("min_salary"),
            F.round(F.max("salary"), 0).cast("double").alias("max_salary"),
            F.round(F.stddev_samp("salary"), 0).alias("salary_stddev"),
        )
        .orderBy("level")
    )


def mean_by(compensation: DataFrame, employees: DataFrame, *keys: str) -> DataFrame:
    """Mean over all history rows by attributes of the employee."""
    per_employee = compensation.groupBy("employee_id").agg(
        F.sum("salary").alias("_sum"), F.count("salary").alias("_rows")
    )
    return (
        per_employee.join(employees.select("employee_id", *keys), "employee_id")
        .groupBy(*keys)
        .agg(mean_of(F.sum("_sum"), F.sum("_rows"), 0).alias("avg_salary"))
    )


def by_department(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    return mean_by(compensation, employees, "department").orderBy(F.desc("avg_salary"), "department")


def pay_gap(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    return mean_by(compensation, employees, "level", "gender").orderBy("level", F.desc("avg_salary"), "gender")


def latest(compensation: DataFrame) -> DataFrame:
    """Newest pay row of each employee; ties on the date go to the later row."""
    return newest(compensation, "employee_id", "effective_date", "comp_id").select(
        "employee_id", "level", "salary", "bonus", "stock", "effective_date"
    )


def _current(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    """Newest pay with the employee's department and own level."""
    staff = employees.select("employee_id", "department", "level")
    return latest(compensation).drop("level").join(staff, "employee_id")


def latest_with_staff(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    return (
        _current(compensation, employees)
        .select("employee_id", "department", "level", "salary", "bonus", "stock", "effective_date")
        .orderBy(F.desc("salary"), "employee_id")
    )


def percentiles(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    """PERCENT_RANK of the newest salary within the level, times 100.

    Five levels would mean five sorting tasks; ranks come from counted salaries.
    """
    # Read twice below, so the scan of the pay history is not repeated.
    current = written(_current(compensation, employees), "current-pay")
    ranked = value_ranks(current, "salary", ["level"], name="_rank")
    share = quotient(F.col("_rank") - 1, F.col("_rank_all") - 1, 1, 100)
    return (
        ranked.withColumn("salary_percentile", F.when(F.col("_rank_all") == 1, 0.0).otherwise(share))
        .select("employee_id", "department", "level", "salary", "salary_percentile")
        .orderBy("level", F.desc("salary_percentile"), "employee_id")
    )


def by_year(compensation: DataFrame) -> DataFrame:
    return (
        compensation.groupBy(F.year("effective_date").alias("comp_year"))
        .agg(mean("salary", 0).alias("avg_salary"), mean("bonus", 0).alias("avg_bonus"))
        .orderBy("comp_year")
    )


def cost_by_department(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    """Newest salary, bonus and stock added up; one row per employee, so rows are heads."""
    total = F.col("salary") + F.col("bonus") + F.col("stock")
    return (
        _current(compensation, employees)
        .groupBy("department")
        .agg(
            F.round(F.sum(total), 0).cast("double").alias("total_comp_cost"),
            F.count("*").alias("headcount"),
            mean(total, 0).alias("avg_total_comp_per_employee"),
        )
        .orderBy(F.desc("total_comp_cost"), "department")
    )


def band_audit(compensation: DataFrame, employees: DataFrame, bands: DataFrame) -> DataFrame:
    """Each pay row against the band of its level; an unknown level has no band and passes."""
    status = (
        F.when(F.col("salary") < F.col("band_min"), "BELOW BAND")
        .when(F.col("salary") > F.col("band_max"), "ABOVE BAND")
        .otherwise("IN BAND")
    )
    # The bands are one row per level, so the broadcast does not grow with the data.
    return (
        compensation.join(employees.select("employee_id", "department"), "employee_id")
        .join(F.broadcast(bands), "level", "left")
        .select("employee_id", "department", "level", "salary", "band_min", "band_max", status.alias("band_status"))
        .orderBy("band_status", "level")
    )


def yearly_growth(compensation: DataFrame) -> DataFrame:
    """Change against the previous pay row of the same employee."""
    yearly = compensation.select(
        "employee_id", F.year("effective_date").alias("comp_year"), "effective_date", "comp_id", "salary"
    )
    order = ["comp_year", "effective_date", "comp_id"]
    lagged = previous_value(yearly, "employee_id", order, "salary", "prev_year_salary")
    growth = quotient(F.col("salary") - F.col("prev_year_salary"), F.col("prev_year_salary"), 2, 100)
    return (
        lagged.filter(F.col("prev_year_salary").isNotNull())
        .orderBy("employee_id", *order)
        .select("employee_id", "comp_year", "salary", "prev_year_salary", growth.alias("yoy_growth_pct"))
    )


def quartiles(compensation: DataFrame, employees: DataFrame) -> DataFrame:
    """NTILE(4) over all newest salaries, ties by employee."""
    rows = _current(compensation, employees).select("employee_id", "department", "level", "salary")
    return global_ntile(rows, 4, "salary", "employee_id", name="salary_quartile").orderBy(
        F.desc("salary_quartile"), F.desc("salary"), "employee_id"
    )
