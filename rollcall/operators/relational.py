"""Relational building blocks over any tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import exact_mean


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def align(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two tables side by side on ``key``; NULL where a side has no row."""
    return left.join(right, key, "full")


def totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """COUNT, SUM, AVG, MIN and MAX of ``value``."""
    return df.groupBy(key).agg(
        F.count("*").alias("row_count"),
        F.sum(value).alias("total"),
        exact_mean(F.sum(value), F.count(value)).alias("average"),
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
    )


def with_group_mean(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """AVG(value) OVER (PARTITION BY key), grouped first: no task sorts a whole group."""
    means = df.groupBy(key).agg(exact_mean(F.sum(value), F.count(value)).alias(name))
    return df.join(means, key, "left")


def having(df: DataFrame, key: str, least: int) -> DataFrame:
    """Groups of more than ``least`` rows."""
    return df.groupBy(key).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > least)


def group_by_alias(df: DataFrame, expression: str, alias: str) -> DataFrame:
    """Row counts by a named expression, in SQL."""
    return df.sparkSession.sql(
        f"SELECT {expression} AS {alias}, count(*) AS row_count FROM {{table}} GROUP BY {alias} ORDER BY {alias}",
        table=df,
    )


def project(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.select(*columns)
