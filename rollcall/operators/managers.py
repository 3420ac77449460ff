"""Manager effect: team measures, scorecards, risk ranks and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import is_exited, mean, mean_of, percent, rate, with_share
from rollcall.functions.picks import newest
from rollcall.operators.quantiles import describe
from rollcall.operators.ranking import global_row_number, small_ranks, tile_of, top
from rollcall.sources.scratch import written

# Fixed flag texts, worst to best: the SQL report, and the scorecard with its markers.
FLAGS = ("HIGH RISK  — Needs Coaching", "AVERAGE    — Monitor", "STAR       — Best Practice")
MARKED_FLAGS = ("🔴 HIGH RISK  — Needs Coaching", "🟡 AVERAGE    — Monitor", "🟢 STAR       — Best Practice")
MARGIN = 5


def _teams(employees: DataFrame) -> DataFrame:
    """Employees who have a manager."""
    return employees.filter(F.col("manager_id").isNotNull()).select("employee_id", "manager_id", "status")


def _reviews(performance: DataFrame) -> DataFrame:
    return performance.groupBy("employee_id").agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("ratings"),
        F.count("*").alias("reviews"),
        F.count_if(F.col("promotion") == "Yes").alias("promotions"),
    )


def _pay(compensation: DataFrame) -> DataFrame:
    return compensation.groupBy("employee_id").agg(
        F.sum("salary").alias("salary_sum"), F.count("salary").alias("salaries"), F.count("*").alias("pay_rows")
    )


def _courses(learning: DataFrame) -> DataFrame:
    return learning.groupBy("employee_id").agg(
        F.sum("hours_completed").alias("hours_sum"),
        F.count("hours_completed").alias("timed"),
        F.count("*").alias("courses"),
    )


def _per_manager(employees: DataFrame, facts: DataFrame) -> DataFrame:
    """Team members with their facts, grouped by manager.

    History is folded to one row per employee before the join, so the join
    never carries history rows and a hot employee costs one row.
    """
    return _teams(employees).join(facts, "employee_id").groupBy("manager_id")



def team_size(employees: DataFrame) -> DataFrame:
    return (
        _teams(employees)
        .groupBy("manager_id")
        .agg(F.count("*").alias("team_size"))
        .orderBy(F.desc("team_size"), "manager_id")
    )


def team_attrition(employees: DataFrame, even: bool = False) -> DataFrame:
    return (
        _teams(employees)
        .groupBy("manager_id")
        .agg(
            F.count("*").alias("team_size"),
            F.count_if(is_exited()).alias("exits"),
            rate(is_exited(), even=even).alias("attrition_rate_pct"),
        )
        .orderBy(F.desc("attrition_rate_pct"), "manager_id")
    )


def team_rating(employees: DataFrame, performance: DataFrame, even: bool = False) -> DataFrame:
    rating = mean_of(F.sum("rating_sum"), F.sum("ratings"), 2, even)
    return (
        _per_manager(employees, _reviews(performance))
        .agg(rating.alias("avg_team_rating"))
        .orderBy(F.desc("avg_team_rating"), "manager_id")
    )


def team_salary(employees: DataFrame, compensation: DataFrame) -> DataFrame:
    """Mean over every history row of the team, as the SQL report has it."""
    return (
        _per_manager(employees, _pay(compensation))
        .agg(mean_of(F.sum("salary_sum"), F.sum("salaries"), 0).alias("avg_team_salary"))
        .orderBy(F.desc("avg_team_salary"), "manager_id")
    )


def team_latest_salary(employees: DataFrame, compensation: DataFrame) -> DataFrame:
    """Mean of each member's newest salary."""
    latest = newest(compensation, "employee_id", "effective_date", "comp_id").select("employee_id", "salary")
    return (
        _per_manager(employees, latest)
        .agg(mean("salary", 0, even=True).alias("avg_team_salary"))
        .orderBy(F.desc("avg_team_salary"), "manager_id")
    )


def team_learning(employees: DataFrame, learning: DataFrame, even: bool = False) -> DataFrame:
    total = F.sum("hours_sum")
    return (
        _per_manager(employees, _courses(learning))
        .agg(
            (F.bround(total, 2) if even else total).alias("total_learning_hours"),
            mean_of(total, F.sum("timed"), 2, even).alias("avg_hours_per_course"),
        )
        .orderBy(F.desc("total_learning_hours"), "manager_id")
    )


def team_promotions(
    employees: DataFrame, performance: DataFrame, count: str = "promotions_given", even: bool = False
) -> DataFrame:
    return (
        _per_manager(employees, _reviews(performance))
        .agg(
            F.sum("reviews").alias("total_appraisals"),
            F.sum("promotions").alias(count),
            percent(F.sum("promotions"), F.sum("reviews"), even=even).alias("promotion_rate_pct"),
        )
        .orderBy(F.desc("promotion_rate_pct"), "manager_id")
    )


def _team_facts(
    employees: DataFrame, performance: DataFrame, pay: DataFrame, learning: DataFrame, even: bool
) -> DataFrame:
    """All team measures from one grouping by manager."""
    members = _teams(employees)
    for part in (_reviews(performance), pay, _courses(learning)):
        members = members.join(part, "employee_id", "left")
    return members.groupBy("manager_id").agg(
        F.count("*").alias("team_size"),
        F.count_if(is_exited()).alias("exits"),
        rate(is_exited(), even=even).alias("attrition_rate_pct"),
        mean_of(F.sum("rating_sum"), F.sum("ratings"), 2, even).alias("avg_team_rating"),
        mean_of(F.sum("salary_sum"), F.sum("salaries"), 0, even).alias("avg_team_salary"),
        F.sum("hours_sum").alias("total_learning_hours"),
        percent(F.sum("promotions"), F.sum("reviews"), even=even).alias("promotion_rate_pct"),
        F.sum("reviews").alias("_reviews"),
        F.sum("pay_rows").alias("_pay_rows"),
        F.sum("courses").alias("_courses"),
    )


def full_scorecard(
    employees: DataFrame, managers: DataFrame, performance: DataFrame, compensation: DataFrame, learning: DataFrame
) -> DataFrame:
    """Managers that have a profile, reviews, pay and courses in their team."""
    facts = _team_facts(employees, performance, _pay(compensation), learning, even=False)
    complete = facts.filter("_reviews > 0 AND _pay_rows > 0 AND _courses > 0")
    profile = managers.select("manager_id", "department", "experience_years")
    return (
        complete.join(profile, "manager_id")
        .select(
            "manager_id",
            "department",
            "experience_years",
            "team_size",
            "exits",
            "attrition_rate_pct",
            "avg_team_rating",
            "avg_team_salary",
            "total_learning_hours",
            "promotion_rate_pct",
        )
        .orderBy(F.desc("attrition_rate_pct"), "manager_id")
    )


def risk_ranks(employees: DataFrame, managers: DataFrame) -> DataFrame:
    """RANK over all, DENSE_RANK within department and NTILE(4) by attrition.

    Rates have two digits, so ranks come from at most 10,001 distinct rates;
    the quartile needs positions, which are counted range by range.
    """
    summary = (
        team_attrition(employees)
        .join(managers.select("manager_id", "department"), "manager_id")
        .select("manager_id", "department", "team_size", "exits", "attrition_rate_pct")
    )
    placed = global_row_number(summary, F.desc("attrition_rate_pct"), F.col("manager_id"), name="_place")
    quartile = tile_of(F.col("_place"), F.col("_place_all"), 4)
    ranked = placed.withColumn("risk_quartile", quartile).drop("_place", "_place_all")
    ranked = small_ranks(ranked, "attrition_rate_pct", descending=True, name="risk_rank")
    ranked = small_ranks(
        ranked, "attrition_rate_pct", ["department"], descending=True, dense=True, name="risk_rank_within_dept"
    )
    return ranked.select(*summary.columns, "risk_rank", "risk_rank_within_dept", "risk_quartile").orderBy(
        "risk_rank", "manager_id"
    )


def _flag(variance: Column, flags: tuple[str, str, str]) -> Column:
    high, middle, star = flags
    return F.when(variance > MARGIN, high).when(variance < -MARGIN, star).otherwise(middle)


def benchmark(employees: DataFrame, flags: tuple[str, str, str] = FLAGS) -> DataFrame:
    """Each manager against the company rate; the flag follows the rounded variance."""
    company = employees.agg(rate(is_exited()).alias("r")).scalar()
    variance = F.round(F.col("attrition_rate_pct") - F.col("company_attrition_pct"), 2)
    return (
        team_attrition(employees)
        .select("manager_id", "attrition_rate_pct", company.alias("company_attrition_pct"))
        .withColumn("variance_from_avg", variance)
        .withColumn("manager_flag", _flag(F.col("variance_from_avg"), flags))
        .orderBy(F.desc("variance_from_avg"), "manager_id")
    )


def scorecard(
    employees: DataFrame,
    performance: DataFrame,
    compensation: DataFrame,
    learning: DataFrame,
    flags: tuple[str, str, str] = MARKED_FLAGS,
) -> DataFrame:
    """Every manager with a team: measures, rank, benchmark, flag and composite risk."""
    latest = newest(compensation, "employee_id", "effective_date", "comp_id")
    facts = _team_facts(employees, performance, _pay(latest), learning, even=True).drop(
        "_reviews", "_pay_rows", "_courses"
    )
    # One row per manager, read for the ranks, for the span of the measures and for the card itself.
    facts = written(facts.withColumn("total_learning_hours", F.bround("total_learning_hours", 2)), "team-facts")
    ranked = small_ranks(facts, "attrition_rate_pct", descending=True, name="risk_rank")
    company = employees.agg(rate(is_exited(), even=True).alias("r")).scalar()
    span = facts.agg(
        F.struct(
            F.min("attrition_rate_pct").alias("a0"),
            F.max("attrition_rate_pct").alias("a1"),
            F.min("avg_team_rating").alias("r0"),
            F.max("avg_team_rating").alias("r1"),
        ).alias("span")
    ).scalar()

    def unit(value: str, low: str, high: str) -> Column:
        lo, hi = F.col(f"_span.{low}"), F.col(f"_span.{high}")
        return (F.col(value) - lo) / (hi - lo + F.lit(1e-9))

    composite = (
        unit("attrition_rate_pct", "a0", "a1") * 0.6 + (F.lit(1.0) - unit("avg_team_rating", "r0", "r1")) * 0.4
    ) * 100
    return (
        ranked.select("*", company.alias("company_avg_attrition_pct"), span.alias("_span"))
        .withColumn(
            "variance_from_avg", F.bround(F.col("attrition_rate_pct") - F.col("company_avg_attrition_pct"), 2)
        )
        .withColumn("manager_flag", _flag(F.col("variance_from_avg"), flags))
        .withColumn("composite_risk_score", F.bround(composite, 1))
        .drop("_span")
        .orderBy(F.desc("attrition_rate_pct"), "manager_id")
    )


def scorecard_ranks(card: DataFrame) -> DataFrame:
    return card.select("manager_id", "attrition_rate_pct", "risk_rank")


def scorecard_benchmark(card: DataFrame) -> DataFrame:
    return card.select(
        "manager_id", "attrition_rate_pct", "company_avg_attrition_pct", "variance_from_avg", "manager_flag"
    )


def composite_risk(card: DataFrame) -> DataFrame:
    return card.select("manager_id", "composite_risk_score")


def counts(card: DataFrame, flags: tuple[str, str, str] = MARKED_FLAGS) -> DataFrame:
    """Managers in all, flagged high-risk and flagged star."""
    return card.agg(
        F.count("*").alias("total_managers"),
        F.first("company_avg_attrition_pct").alias("company_avg_attrition_pct"),
        F.count_if(F.col("manager_flag") == flags[0]).alias("high_risk_managers"),
        F.count_if(F.col("manager_flag") == flags[2]).alias("star_managers"),
    )


def highest_risk(card: DataFrame, n: int = 10) -> DataFrame:
    return top(card, n, F.desc("attrition_rate_pct"), "manager_id").select(
        "manager_id",
        "team_size",
        "exits",
        "attrition_rate_pct",
        "avg_team_rating",
        "variance_from_avg",
        "manager_flag",
    )


def stars(card: DataFrame, n: int = 10) -> DataFrame:
    """Lowest attrition, then best rating."""
    return top(card, n, "attrition_rate_pct", F.desc_nulls_last("avg_team_rating"), "manager_id").select(
        "manager_id",
        "team_size",
        "attrition_rate_pct",
        "avg_team_rating",
        "promotion_rate_pct",
        "total_learning_hours",
    )


def flag_distribution(card: DataFrame) -> DataFrame:
    groups = card.groupBy("manager_flag").agg(F.count("*").alias("managers"))
    return with_share(groups, "managers", "percentage", 1, even=True).orderBy(F.desc("managers"), "manager_flag")


def attrition_quartiles(card: DataFrame) -> DataFrame:
    rates = card.select(F.col("attrition_rate_pct").cast("decimal(5,2)").alias("attrition_rate_pct"))
    return describe(rates, "attrition_rate_pct")
