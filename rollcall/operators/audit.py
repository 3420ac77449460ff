"""Distribution audits of the loaded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import is_active, mean, mean_of, percent, with_share
from rollcall.operators.quantiles import describe


def frequencies(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Counts and shares of the non-NULL values of ``column``: attribute, value, row_count, share_pct."""
    groups = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("row_count"))
    )
    return (
        with_share(groups, "row_count", "share_pct", digits, even=True)
        .select(F.lit(column).alias("attribute"), "value", "row_count", "share_pct")
        .orderBy(F.desc("row_count"), "value")
    )


def attrition_shares(employees: DataFrame) -> DataFrame:
    return frequencies(employees, "status")


def exit_share(employees: DataFrame, exits: DataFrame) -> DataFrame:
    """Exit records as a share of all employees."""
    staff = employees.agg(F.count("*").alias("n")).scalar()
    return exits.agg(F.count("*").alias("exits")).select("exits", percent(F.col("exits"), staff).alias("share_pct"))


def rating_shares(performance: DataFrame) -> DataFrame:
    return frequencies(performance, "rating")


def band_targets(compensation: DataFrame, bands: DataFrame) -> DataFrame:
    """Target band against the lowest and highest actual salary, per level."""
    actual = compensation.groupBy("level").agg(F.min("salary").alias("min_actual"), F.max("salary").alias("max_actual"))
    drift = (F.col("min_actual") < F.col("band_min")) | (F.col("max_actual") > F.col("band_max"))
    return (
        actual.join(F.broadcast(bands), "level")
        .select("level", "band_min", "band_max", "min_actual", "max_actual", drift.alias("has_drift"))
        .orderBy("level")
    )


def learning_profile(learning: DataFrame) -> DataFrame:
    return frequencies(learning, "skill_category").unionByName(frequencies(learning, "completion_status"))


def project_profile(projects: DataFrame) -> DataFrame:
    return frequencies(projects, "client_name").unionByName(frequencies(projects, "billable"))


def team_sizes(employees: DataFrame) -> DataFrame:
    """Mean, least and greatest number of active members per manager."""
    sizes = (
        employees.filter(is_active() & F.col("manager_id").isNotNull())
        .groupBy("manager_id")
        .agg(F.count("*").alias("team_size"))
    )
    return sizes.agg(
        mean_of(F.sum("team_size"), F.count("*"), 2).alias("avg_team_size"),
        F.min("team_size").alias("min_team_size"),
        F.max("team_size").alias("max_team_size"),
    )


def exit_profile(exits: DataFrame) -> DataFrame:
    return frequencies(exits, "exit_reason").unionByName(frequencies(exits, "voluntary"))


def salary_profile(compensation: DataFrame) -> DataFrame:
    return describe(compensation, "salary")


def salary_by_level(compensation: DataFrame) -> DataFrame:
    return (
        compensation.groupBy("level").agg(mean("salary", 2, even=True).alias("avg_salary")).orderBy("level")
    )
