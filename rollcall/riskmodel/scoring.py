"""Risk scores and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.buckets import right_closed
from rollcall.functions.measures import mean, percent
from rollcall.operators.ranking import top

# Upper edges of the risk tiers, and the score a group is called high from.
TIERS = ((20, "Very Low"), (40, "Low"), (60, "Medium"), (80, "High"), (100, "Critical"))
HIGH, CRITICAL = 60, 80
MIN_GROUP = 10


def risk_columns(scored: DataFrame) -> DataFrame:
    """``prob`` turned into score (one digit), probability (four digits) and tier.

    A score of exactly 0 lies outside the first tier and gets none.
    """
    percent_score = F.bround(F.col("prob") * 100, 1)
    return (
        scored.withColumn("risk_score", percent_score)
        .withColumn("attrition_prob", F.bround("prob", 4))
        .withColumn("risk_tier", right_closed(F.col("risk_score"), 0, TIERS))
    )


def tiers(risk: DataFrame) -> DataFrame:
    return risk.select("employee_id", "risk_score", "risk_tier")


def _score_mean():
    # Scores have one digit, so their sum is exact in DECIMAL.
    return mean(F.col("risk_score").cast("decimal(5,1)"), 1, even=True)


def department_summary(risk: DataFrame, employees: DataFrame) -> DataFrame:
    high = F.count_if(F.col("risk_score") >= HIGH)
    return (
        risk.select("employee_id", "risk_score", "attrition", "predicted_attrition")
        .join(employees.select("employee_id", "department"), "employee_id", "left")
        .filter(F.col("department").isNotNull())
        .groupBy("department")
        .agg(
            F.count("*").alias("total_employees"),
            _score_mean().alias("avg_risk_score"),
            high.alias("high_risk_count"),
            F.count_if(F.col("risk_score") >= CRITICAL).alias("critical_risk_count"),
            F.sum("attrition").alias("actual_exits"),
            F.sum("predicted_attrition").alias("predicted_exits"),
            percent(high, F.count("*"), 1, even=True).alias("high_risk_pct"),
        )
        .orderBy(F.desc("avg_risk_score"), "department")
    )


def _manager_groups(risk: DataFrame, employees: DataFrame) -> DataFrame:
    high = F.count_if(F.col("risk_score") >= HIGH)
    return (
        risk.select("employee_id", "risk_score", "attrition", "predicted_attrition")
        .join(employees.select("employee_id", "manager_id"), "employee_id", "left")
        .filter(F.col("manager_id").isNotNull())
        .groupBy("manager_id")
        .agg(
            F.count("*").alias("team_size"),
            _score_mean().alias("avg_risk_score"),
            high.alias("high_risk_count"),
            F.sum("attrition").alias("actual_exits"),
            F.sum("predicted_attrition").alias("predicted_exits"),
            percent(high, F.count("*"), 1, even=True).alias("high_risk_pct"),
        )
    )


def manager_summary(risk: DataFrame, employees: DataFrame, k: int = MIN_GROUP) -> DataFrame:
    """Teams of at least ``k``; smaller ones are withheld to protect individuals."""
    groups = _manager_groups(risk, employees).filter(F.col("team_size") >= k)
    return groups.orderBy(F.desc("avg_risk_score"), "manager_id")


def suppressed_managers(risk: DataFrame, employees: DataFrame, k: int = MIN_GROUP) -> DataFrame:
    return _manager_groups(risk, employees).agg(F.count_if(F.col("team_size") < k).alias("suppressed_managers"))


def snapshot(risk: DataFrame) -> DataFrame:
    high = F.count_if(F.col("risk_score") >= HIGH)
    critical = F.count_if(F.col("risk_score") >= CRITICAL)
    return risk.agg(
        F.count("*").alias("total_scored"),
        F.count_if(F.col("attrition") == 0).alias("active_employees"),
        _score_mean().alias("avg_risk_score"),
        high.alias("high_risk"),
        percent(high, F.count("*"), 1).alias("high_risk_pct"),
        critical.alias("critical"),
        percent(critical, F.count("*"), 1).alias("critical_pct"),
    )


def tier_distribution(risk: DataFrame) -> DataFrame:
    """Rows per tier; the share is in all scored rows, with or without a tier."""
    everyone = risk.agg(F.count("*").alias("n")).scalar()
    return (
        risk.filter(F.col("risk_tier").isNotNull())
        .groupBy("risk_tier")
        .agg(F.count("*").alias("row_count"))
        .withColumn("share_pct", percent(F.col("row_count"), everyone, 1))
    )


def top_active(risk: DataFrame, n: int = 20) -> DataFrame:
    staying = risk.filter(F.col("attrition") == 0).select("employee_id", "risk_score", "risk_tier")
    return top(staying, n, F.desc("risk_score"), "employee_id")
