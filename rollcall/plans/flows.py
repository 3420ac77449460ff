"""The analyses end to end, from tables to written results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import managers, quality, survival
from rollcall.riskmodel import explain, features, metrics, scoring, train
from rollcall.schema import bands_frame
from rollcall.sources import readers, sinks
from rollcall.sources.scratch import written


def run_validation(
    spark: SparkSession, directory: str, as_of: dt.date, report_path: str | None = None, format: str = "csv"
) -> bool:
    """Check the tables in ``directory``; True when every check passed."""
    tables = readers.load_raw(spark, directory, format=format)
    report = written(quality.validation_report(tables, bands_frame(spark), as_of), "validation")
    if report_path:
        sinks.save_report(report, report_path, as_of)
    return quality.all_passed(report)


def run_manager_analysis(tables: Mapping[str, DataFrame], path: str | None = None) -> DataFrame:
    card = managers.scorecard(
        tables["employees"], tables["performance"], tables["compensation"], tables["learning"]
    )
    if path:
        sinks.save_dataframe(card, path, "csv")
    return card


def run_retention_analysis(
    employees: DataFrame, exits: DataFrame, as_of: dt.date, folder: str | None = None
) -> dict[str, DataFrame]:
    """Curves, summaries and tests; written below ``folder`` if given."""
    # Read by every analysis below.
    base = written(survival.survival_input(employees, exits, as_of), "spells")
    curves = {
        "overall": survival.overall(base),
        "college_tier": survival.by_college_tier(base),
        "role": survival.by_role(base),
        "department": survival.by_department(base),
        "joining_year": survival.by_joining_year(base),
    }
    summaries = {name: survival.summary(curve) for name, curve in curves.items()}
    results = {
        "km_retention": curves["overall"],
        "km_by_college_tier": survival.wide(curves["college_tier"]),
        "km_by_college_tier_summary": summaries["college_tier"],
        "km_by_role": summaries["role"],
        "km_by_department": summaries["department"],
        "km_by_joining_year": summaries["joining_year"],
        "logrank": survival.logrank_test(base),
        "retention_summary": survival.executive_summary(summaries["overall"], summaries["college_tier"]),
    }
    if folder:
        for name, df in results.items():
            sinks.save_dataframe(df, f"{folder}/{name}", "csv")
    return results


def feature_matrix(tables: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    return features.feature_matrix(
        tables["employees"],
        tables["performance"],
        tables["compensation"],
        tables["learning"],
        tables["projects"],
        tables["exits"],
        tables.get("managers"),
        as_of=as_of,
    )


@dataclass(frozen=True)
class Trained:
    """A fitted model, its feature columns and the rows on both sides of the split."""

    model: train.Ensemble
    columns: list[str]
    train: DataFrame
    test: DataFrame


def run_training(matrix: DataFrame, cutoff: int, **settings) -> Trained:
    columns = features.feature_columns(matrix)
    fit, held = features.time_split(matrix, cutoff)
    return Trained(train.train(fit, columns, **settings), columns, fit, held)


def run_evaluation(trained: Trained, threshold: float | None = None, tune_on: str = "validation") -> DataFrame:
    """Metrics with the number of rounds, one row.

    Without ``threshold``, it is tuned on the slice training left out, or on the
    test rows with ``tune_on="test"``.
    """
    if tune_on not in ("validation", "test"):
        raise ValueError(f"tune_on is validation or test, not {tune_on!r}")
    keep = ("employee_id", "attrition", "prob")
    fit = written(train.score(trained.model, trained.train).select(*keep), "train-scores")
    held = written(train.score(trained.model, trained.test).select(*keep), "test-scores")
    tuning = fit.filter(train.held_out()) if tune_on == "validation" else None
    result = metrics.evaluate(fit, held, threshold, tuning)
    return result.withColumn("n_iter", F.lit(train.rounds_used(trained.model)))


def run_prediction(
    trained: Trained, matrix: DataFrame, employees: DataFrame, folder: str | None = None
) -> dict[str, DataFrame]:
    """Scores of all employees and both summaries."""
    risk = scoring.risk_columns(train.score(trained.model, matrix))
    results = {
        "predictions": risk,
        "dept_risk_summary": scoring.department_summary(risk, employees),
        "manager_risk_summary": scoring.manager_summary(risk, employees),
    }
    if folder:
        for name, df in results.items():
            sinks.save_dataframe(df, f"{folder}/{name}", "csv")
    return results


def run_explanation(trained: Trained) -> dict[str, DataFrame]:
    """Contributions of the test rows and what is read off them."""
    parts = written(explain.contributions(trained.model, trained.test, trained.columns), "contributions")
    return {
        "contributions": parts,
        "feature_importance": explain.importance(parts),
        "spread": explain.spread_of_top(parts),
        "highest_risk": explain.highest_risk(trained.model, trained.test, trained.columns),
        "dependence": explain.dependence(parts),
    }
