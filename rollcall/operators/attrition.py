"""Attrition: rates by any key, exits by year, type and reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import is_exited, rate, with_share


def overall(employees: DataFrame) -> DataFrame:
    return employees.agg(rate(is_exited()).alias("overall_attrition_pct"))


def by(employees: DataFrame, key: str) -> DataFrame:
    return (
        employees.groupBy(key)
        .agg(
            F.count("*").alias("total_employees"),
            F.count_if(is_exited()).alias("exited"),
            rate(is_exited()).alias("attrition_rate_pct"),
        )
        .orderBy(F.desc("attrition_rate_pct"), key)
    )


def exits_per_year(exits: DataFrame) -> DataFrame:
    return (
        exits.groupBy(F.year("exit_date").alias("exit_year"))
        .agg(F.count("*").alias("exits_in_year"))
        .orderBy("exit_year")
    )


def voluntary_split(exits: DataFrame) -> DataFrame:
    kind = F.when(F.col("voluntary"), "Voluntary").otherwise("Involuntary")
    groups = exits.groupBy("voluntary").agg(F.count("*").alias("exits")).withColumn("attrition_type", kind)
    return with_share(groups, "exits", "percentage").select("attrition_type", "exits", "percentage").orderBy(
        F.desc("exits"), "attrition_type"
    )


def reasons(exits: DataFrame) -> DataFrame:
    groups = exits.groupBy("exit_reason").agg(F.count("*").alias("total_exits"))
    return with_share(groups, "total_exits", "percentage").orderBy(F.desc("total_exits"), "exit_reason")


def above_company(employees: DataFrame, key: str = "department") -> DataFrame:
    """Groups whose rate exceeds the company's, both rounded before the comparison."""
    groups = employees.groupBy(key).agg(
        rate(is_exited()).alias("attrition_pct")
    )
    company = employees.agg(rate(is_exited()).alias("r")).scalar()
    return (
        groups.select(key, "attrition_pct", company.alias("avg_attrition"))
        .filter("attrition_pct > avg_attrition")
        .withColumn("variance_from_avg", F.round(F.col("attrition_pct") - F.col("avg_attrition"), 2))
        .orderBy(F.desc("variance_from_avg"), key)
    )
