"""All registered queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans import analyses, basics, checks, reports, risk
from rollcall.plans.bound import bound, plain
from rollcall.plans.oracle import with_tables

CASES: dict = {
    **basics.QUERIES,
    **reports.QUERIES,
    **checks.QUERIES,
    **analyses.QUERIES,
    **risk.QUERIES,
}


def _runner(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: plain(build(bound(spark, directory)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, (build, _) in CASES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql, risk.EXTRA) for name, (_, sql) in CASES.items() if sql}
