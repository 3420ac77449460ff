"""Career rules: promotion screen, merit cycle, attrition scorecard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.picks import last_value, order_key
from rollcall.operators import salary
from rollcall.schema import PROJECT_DIFFICULTY

STRESS = ("Low", "Medium", "High")


def career_state(
    employees: DataFrame,
    performance: DataFrame,
    learning: DataFrame,
    exits: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """What the rules look at, per employee.

    Years, ratings and learning hours count since the last promotion, or since
    joining. History is folded per (employee, year) before the join, so a hot
    employee brings a row per year.
    """
    yearly = performance.groupBy("employee_id", "review_year").agg(
        F.sum("rating").alias("_sum"),
        F.count("rating").alias("_n"),
        F.max(F.when(F.col("promotion") == "Yes", F.col("review_year"))).alias("_promoted"),
        last_value("rating", order_key(F.col("review_year"), F.col("rating_id"))).alias("_rating"),
    )
    history = F.collect_list(F.struct("review_year", "_sum", "_n"))
    reviews = yearly.groupBy("employee_id").agg(
        F.max("_promoted").alias("last_promotion_year"),
        last_value("_rating", F.col("review_year")).alias("latest_rating"),
        history.alias("_years"),
    )
    hours = (
        learning.groupBy("employee_id", F.year("completion_date").alias("_year"))
        .agg(F.sum("hours_completed").alias("_hours"))
        .groupBy("employee_id")
        .agg(F.collect_list(F.struct("_year", "_hours")).alias("_courses"))
    )
    since = F.coalesce("last_promotion_year", F.year("joining_date") - 1)
    last_year = F.coalesce(F.year("exit_date"), F.lit(as_of.year))

    def added(rows: str, year: str, value: str, zero: Column, undated: bool) -> Column:
        # Courses without a completion date are still running and count.
        kept = F.filter(
            F.col(rows), lambda r: (r[year] > F.col("_since")) | (r[year].isNull() if undated else F.lit(False))
        )
        return F.coalesce(F.aggregate(kept, zero, lambda acc, r: acc + r[value]), zero)

    zero = F.lit(0).cast("bigint")
    joined = (
        employees.select("employee_id", "department", "level", "college_tier", "joining_date", "status")
        .join(reviews, "employee_id", "left")
        .join(hours, "employee_id", "left")
        .join(exits.select("employee_id", "exit_date"), "employee_id", "left")
        .withColumn("_since", since)
    )
    return joined.select(
        "employee_id",
        "department",
        "level",
        "college_tier",
        "status",
        "latest_rating",
        (F.lit(as_of.year) - F.coalesce("last_promotion_year", F.year("joining_date"))).alias("years_in_level"),
        (last_year - F.year("joining_date") + 1).alias("total_tenure"),
        added("_years", "review_year", "_sum", zero, False).alias("rating_sum"),
        added("_years", "review_year", "_n", zero, False).alias("rating_count"),
        added("_courses", "_year", "_hours", F.lit(0.0), True).alias("learning_hours"),
    )


def promotion_screen(state: DataFrame, rules: DataFrame) -> DataFrame:
    """Who meets years, mean rating and learning hours of the next level.

    The top level has no rule and nobody without ratings is eligible.
    """
    met = (
        (F.col("rating_count") > 0)
        & (F.col("years_in_level") >= F.col("min_years"))
        & (F.col("rating_sum") >= F.col("min_avg_rating") * F.col("rating_count"))
        & (F.col("learning_hours") >= F.col("min_learning_hours"))
    )
    # One rule per level.
    return (
        state.join(F.broadcast(rules), "level", "left")
        .withColumn("eligible", F.coalesce(met, F.lit(False)))
        .select(
            "employee_id",
            "level",
            "years_in_level",
            "rating_count",
            "learning_hours",
            "eligible",
            F.when(F.col("eligible"), F.col("next_level")).otherwise(F.col("level")).alias("new_level"),
        )
    )


def merit_cycle(
    screen: DataFrame, state: DataFrame, compensation: DataFrame, bands: DataFrame, merit: DataFrame
) -> DataFrame:
    """Next year's pay of staff with a rating.

    A hike by rating, capped at the top of the band; promoted staff enter the
    new band at its minimum at least, without a cap. Bonus by rating; stock is a
    tenth of salary at the two highest levels. Amounts are cut to whole units.
    """
    pay = salary.latest(compensation).select("employee_id", "salary")
    raised = F.col("salary") * (F.lit(Decimal(1)) + F.col("hike"))
    new = F.when(F.col("eligible"), F.greatest(raised, F.col("band_min"))).otherwise(
        F.least(raised, F.col("band_max"))
    )
    whole = "bigint"
    return (
        screen.select("employee_id", "eligible", F.col("new_level").alias("level"))
        .join(state.select("employee_id", F.col("latest_rating").alias("rating")), "employee_id")
        .join(pay, "employee_id")
        .join(F.broadcast(merit), "rating")
        .join(F.broadcast(bands), "level")
        .withColumn("_new", new)
        .select(
            "employee_id",
            "level",
            "rating",
            F.col("eligible").alias("promoted"),
            F.col("salary").alias("current_salary"),
            F.floor("_new").cast(whole).alias("new_salary"),
            F.floor(F.col("_new") * F.col("bonus_rate")).cast(whole).alias("new_bonus"),
            F.when(F.col("level").isin("L4", "L5"), F.floor(F.col("_new") * F.lit(Decimal("0.10"))))
            .otherwise(0)
            .cast(whole)
            .alias("new_stock"),
        )
    )


def project_stress(projects: DataFrame, difficulty: Mapping[str, str] = PROJECT_DIFFICULTY) -> DataFrame:
    """Difficulty of the project an employee started last; the harder one on a tie."""
    pairs = [x for name, stress in difficulty.items() for x in (F.lit(name), F.lit(STRESS.index(stress)))]
    level = F.coalesce(F.element_at(F.create_map(*pairs), F.col("project_name")), F.lit(1)) if pairs else F.lit(1)
    # Start day and difficulty in one number, so the newest is a plain max.
    newest = F.max(F.unix_date("start_date") * 10 + level)
    return projects.groupBy("employee_id").agg(F.pmod(newest, F.lit(10)).alias("_code")).select(
        "employee_id", F.element_at(F.array(*[F.lit(s) for s in STRESS]), F.col("_code") + 1).alias("project_stress")
    )


def attrition_score(
    state: DataFrame,
    compensation: DataFrame,
    projects: DataFrame,
    bands: DataFrame,
    difficulty: Mapping[str, str] = PROJECT_DIFFICULTY,
) -> DataFrame:
    """Additive attrition probability per employee, clipped to 0.001..0.60."""
    pay = salary.latest(compensation).select("employee_id", "salary")
    middle = (F.col("band_min") + F.col("band_max")) / 2
    facts = (
        state.join(pay, "employee_id", "left")
        .join(project_stress(projects, difficulty), "employee_id", "left")
        .join(F.broadcast(bands), "level", "left")
        .withColumn("salary_ratio", F.col("salary").cast("double") / middle.cast("double"))
    )

    def p(text: str) -> Column:
        return F.lit(Decimal(text)).cast("decimal(6,3)")

    rating, ratio = F.col("latest_rating"), F.col("salary_ratio")
    years, hours, tenure = F.col("years_in_level"), F.col("learning_hours"), F.col("total_tenure")
    none = p("0.000")
    # The additive terms of the score.
    terms = [
        F.when(rating == 1, p("0.080"))
        .when(rating == 2, p("0.040"))
        .when(rating == 4, p("-0.010"))
        .when(rating == 5, p("-0.020")),
        F.when(F.col("college_tier") == "Tier-2", p("0.005")).when(F.col("college_tier") == "Tier-3", p("0.010")),
        F.when(years >= 4, p("0.025")).when(years >= 3, p("0.010")),
        F.when(F.col("project_stress") == "High", p("0.010")).when(F.col("project_stress") == "Low", p("-0.005")),
        F.when(hours >= 40, p("-0.010")).when(hours < 8, p("0.010")),
        F.when(ratio < 0.85, p("0.020")).when(ratio > 1.15, p("-0.010")),
        F.when(tenure <= 1, p("-0.005")).when(tenure >= 5, p("-0.010")).otherwise(p("0.005")),
    ]
    total = p("0.015")
    for term in terms:
        total = total + F.coalesce(term, none)
    clipped = F.greatest(p("0.001"), F.least(total, p("0.600")))
    return facts.select(
        "employee_id",
        "latest_rating",
        F.coalesce("project_stress", F.lit("Medium")).alias("project_stress"),
        "salary_ratio",
        "years_in_level",
        "learning_hours",
        "total_tenure",
        clipped.cast("double").alias("attrition_prob"),
    )
