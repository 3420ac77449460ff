"""Learning: hours, skills, completion, learners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.buckets import below
from rollcall.functions.measures import mean, mean_of, rate, with_share
from rollcall.operators.ranking import top_ranked


def _per_employee(learning: DataFrame) -> DataFrame:
    """Hours and courses of each employee: joins and rankings start from this, not from the rows."""
    return learning.groupBy("employee_id").agg(
        F.sum("hours_completed").alias("total_hours"),
        F.count("hours_completed").alias("_timed"),
        F.count("*").alias("courses_taken"),
    )


def hours_by_department(learning: DataFrame, employees: DataFrame) -> DataFrame:
    return (
        _per_employee(learning)
        .join(employees.select("employee_id", "department"), "employee_id")
        .groupBy("department")
        .agg(
            F.sum("total_hours").alias("total_hours"),
            mean_of(F.sum("total_hours"), F.sum("_timed"), 2).alias("avg_hours_per_course"),
            F.sum("courses_taken").alias("total_enrollments"),
        )
        .orderBy(F.desc("total_hours"), "department")
    )


def skills(learning: DataFrame) -> DataFrame:
    groups = learning.groupBy("skill_category").agg(
        F.count("*").alias("enrollments"), F.sum("hours_completed").alias("total_hours")
    )
    return with_share(groups, "enrollments", "enrollment_share_pct").orderBy(F.desc("enrollments"), "skill_category")


def completion_by_skill(learning: DataFrame) -> DataFrame:
    done = F.col("completion_status") == "Completed"
    return (
        learning.groupBy("skill_category")
        .agg(
            F.count("*").alias("total_enrollments"),
            F.count_if(done).alias("completed"),
            rate(done).alias("completion_rate_pct"),
        )
        .orderBy(F.desc("completion_rate_pct"), "skill_category")
    )


def top_learners(learning: DataFrame, employees: DataFrame, n: int = 20) -> DataFrame:
    hours = _per_employee(learning).drop("_timed")
    staff = employees.select("employee_id", "department", "level")
    ranked = top_ranked(hours.join(staff, "employee_id"), n, "total_hours", "employee_id", "learner_rank")
    return ranked.select("employee_id", "department", "level", "total_hours", "courses_taken", "learner_rank")


def hours_by_level(learning: DataFrame, employees: DataFrame) -> DataFrame:
    return (
        _per_employee(learning)
        .join(employees.select("employee_id", "level"), "employee_id")
        .groupBy("level")
        .agg(mean("total_hours", 2).alias("avg_hours_per_employee"))
        .orderBy("level")
    )


LEARNING_BANDS = ((20, "Low  (<20 hrs)"), (50, "Mid  (20-49 hrs)"), (100, "High (50-99 hrs)"))


def band_vs_rating(learning: DataFrame, performance: DataFrame) -> DataFrame:
    """Mean of employees' mean ratings (rounded first) per band of learning hours."""
    hours = _per_employee(learning).select("employee_id", "total_hours")
    ratings = performance.groupBy("employee_id").agg(
        mean("rating", 2).cast("decimal(6,2)").alias("avg_rating")
    )
    return (
        hours.join(ratings, "employee_id")
        .groupBy(below(F.col("total_hours"), LEARNING_BANDS, "Top  (100+ hrs)").alias("learning_band"))
        .agg(F.count("*").alias("employees"), mean("avg_rating", 3).alias("avg_performance_rating"))
        .orderBy(F.desc("avg_performance_rating"), "learning_band")
    )


def completions_per_year(learning: DataFrame) -> DataFrame:
    done = (F.col("completion_status") == "Completed") & F.col("completion_date").isNotNull()
    return (
        learning.filter(done)
        .groupBy(F.year("completion_date").alias("completion_year"))
        .agg(F.count("*").alias("courses_completed"), F.sum("hours_completed").alias("hours_completed"))
        .orderBy("completion_year")
    )
