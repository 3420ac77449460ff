"""Feature matrix: one row per employee.

Every history table is folded to one row per employee with a single grouping;
the folded tables are hash-partitioned alike, so the joins add no shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import day, tenure_months
from rollcall.functions.measures import is_exited, mean, quotient
from rollcall.functions.picks import first_value, last_value, order_key
from rollcall.operators.quantiles import exact_quantiles
from rollcall.sources.scratch import written

CATEGORICAL = ("gender", "department", "location", "level", "college_tier")
# Neither features nor inputs of one.
DROPPED = ("status", "joining_date", "exit_date", "end_date", "role", "manager_id")
NOT_FEATURES = ("employee_id", "attrition", "joining_year", "joining_month")


def target_and_tenure(employees: DataFrame, exits: DataFrame, as_of: dt.date) -> DataFrame:
    """Employees with target, tenure and joining year and month.

    Tenure of those who left ends at the exit, which leaks the target into the
    features; it is kept because the scores are defined that way.
    """
    left = exits.select("employee_id", "exit_date")
    return (
        employees.join(left, "employee_id", "left")
        .withColumn("attrition", is_exited().cast("int"))
        .withColumn("end_date", F.coalesce(F.col("exit_date"), day(as_of)))
        .withColumn("tenure_months", tenure_months(F.col("end_date"), F.col("joining_date")))
        .withColumn("joining_year", F.year("joining_date"))
        .withColumn("joining_month", F.month("joining_date"))
    )


def compensation_features(compensation: DataFrame) -> DataFrame:
    """Newest pay and growth from first to last salary; NULLs are passed over."""
    order = order_key(F.unix_date("effective_date"), F.col("comp_id"))
    picked = compensation.groupBy("employee_id").agg(
        last_value("salary", order).alias("_last"),
        first_value("salary", order).alias("_first"),
        last_value("bonus", order).alias("_bonus"),
        last_value("stock", order).alias("_stock"),
    )
    growth = quotient(F.col("_last") - F.col("_first"), F.col("_first"), 2, 100, even=True)
    return picked.select(
        "employee_id",
        F.col("_last").cast("double").alias("latest_salary"),
        F.col("_bonus").cast("double").alias("latest_bonus"),
        F.col("_stock").cast("double").alias("latest_stock"),
        F.coalesce(growth, F.lit(0.0)).alias("salary_growth_pct"),
    )


def performance_features(performance: DataFrame) -> DataFrame:
    """Mean and newest rating, trend, promotions: one grouping for all."""
    order = order_key(F.col("review_year"), F.col("rating_id"))
    promoted = F.count_if(F.col("promotion") == "Yes")
    return (
        performance.groupBy("employee_id")
        .agg(
            mean("rating", 2, even=True).alias("avg_rating"),
            last_value("rating", order).alias("latest_rating"),
            first_value("rating", order).alias("_first"),
            promoted.alias("promotion_count"),
            quotient(promoted, F.count("*"), 3, even=True).alias("promotion_rate"),
        )
        .withColumn("rating_trend", F.col("latest_rating") - F.col("_first"))
        .select("employee_id", "avg_rating", "latest_rating", "rating_trend", "promotion_count", "promotion_rate")
    )


def learning_features(learning: DataFrame) -> DataFrame:
    done = F.count_if(F.col("completion_status") == "Completed")
    return learning.groupBy("employee_id").agg(
        F.sum("hours_completed").alias("total_learning_hours"),
        F.count("course_name").alias("courses_taken"),
        F.coalesce(quotient(done, F.count("course_name"), 3, even=True), F.lit(0.0)).alias("completion_rate"),
    )


def project_features(projects: DataFrame) -> DataFrame:
    billable = F.count_if(F.lower(F.col("billable").cast("string")).isin("true", "yes"))
    return projects.groupBy("employee_id").agg(
        F.count("project_name").alias("project_count"),
        F.coalesce(quotient(billable, F.count("project_name"), 3, even=True), F.lit(0.0)).alias("billable_ratio"),
    )


def with_learning(base: DataFrame, learning: DataFrame) -> DataFrame:
    added = ["total_learning_hours", "courses_taken", "completion_rate"]
    return base.join(learning_features(learning), "employee_id", "left").fillna(0, added)


def with_projects(base: DataFrame, projects: DataFrame) -> DataFrame:
    return base.join(project_features(projects), "employee_id", "left").fillna(0, ["project_count", "billable_ratio"])


def with_manager_experience(base: DataFrame, managers: DataFrame | None) -> DataFrame:
    """Experience of the manager; the median over employees where there is none.

    Experience is a small whole number, so the exact median counts few values.
    """
    if managers is None:
        return base.withColumn("manager_experience_years", F.lit(0.0))
    joined = base.join(managers.select("manager_id", "experience_years"), "manager_id", "left")
    middle = joined.agg(F.median("experience_years").alias("m")).scalar()
    filled = F.coalesce(F.col("experience_years").cast("double"), middle)
    return joined.withColumn("manager_experience_years", filled).drop("experience_years")


def categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> dict[str, list[str]]:
    """Sorted distinct values of each column. The values become columns, so they must be few."""
    rows = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .collect()
    )
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["column_name"]].append(row["value"])
    return {c: sorted(values) for c, values in found.items()}


def one_hot(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """0/1 column per category, none left out; a NULL is 0 everywhere."""
    flags = [
        F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for c, found in values.items() for v in found
    ]
    return df.select(*[c for c in df.columns if c not in values], *flags)


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs in ``columns`` with the exact median of the column.

    One pass counts NULLs; medians are found only for columns that have some.
    Both results are one number per column.
    """
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gaps = [c for c in columns if nulls[c]]
    if not gaps:
        return df
    medians = {r["column_name"]: r["median"] for r in exact_quantiles(df, gaps, {"median": 0.5}).collect()}
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in gaps if medians.get(c) is not None}
    )


NUMERIC = (
    "age",
    "tenure_months",
    "latest_salary",
    "latest_bonus",
    "latest_stock",
    "salary_growth_pct",
    "avg_rating",
    "latest_rating",
    "rating_trend",
    "promotion_count",
    "promotion_rate",
    "total_learning_hours",
    "courses_taken",
    "completion_rate",
    "project_count",
    "billable_ratio",
    "manager_experience_years",
)


def assemble(
    employees: DataFrame,
    performance: DataFrame,
    compensation: DataFrame,
    learning: DataFrame,
    projects: DataFrame,
    exits: DataFrame,
    managers: DataFrame | None,
    as_of: dt.date,
) -> DataFrame:
    """All measures joined, before encoding and filling."""
    base = target_and_tenure(employees, exits, as_of)
    base = base.join(compensation_features(compensation), "employee_id", "left")
    base = base.join(performance_features(performance), "employee_id", "left")
    base = with_projects(with_learning(base, learning), projects)
    return with_manager_experience(base, managers)


def finish(assembled: DataFrame) -> DataFrame:
    """Encode, drop and fill an assembled table, which is read more than once."""
    encoded = one_hot(assembled.drop(*DROPPED), categories(assembled))
    return fill_medians(encoded, [*NUMERIC, "joining_year", "joining_month"])


def feature_matrix(*tables: DataFrame | None, as_of: dt.date) -> DataFrame:
    """The feature matrix; arguments as for :func:`assemble`.

    The joined table is written once: the categories, the medians and the
    matrix itself are all read from it.
    """
    return finish(written(assemble(*tables, as_of=as_of), "features"))


def feature_columns(matrix: DataFrame) -> list[str]:
    return [c for c in matrix.columns if c not in NOT_FEATURES]


def time_split(matrix: DataFrame, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Train on those who joined up to ``cutoff``, test on those who joined later."""
    return matrix.filter(F.col("joining_year") <= cutoff), matrix.filter(F.col("joining_year") > cutoff)


def split_label(cutoff: int) -> Column:
    return F.when(F.col("joining_year") <= cutoff, "train").otherwise("test")
