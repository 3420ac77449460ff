"""Headcount: totals, splits and hires."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import is_active, with_share


def total(employees: DataFrame) -> DataFrame:
    return employees.agg(F.count("*").alias("total_employees"))


def by(employees: DataFrame, key: str, name: str = "employees") -> DataFrame:
    """Rows per value of ``key``, largest first."""
    return employees.groupBy(key).agg(F.count("*").alias(name)).orderBy(F.desc(name), key)


def split(df: DataFrame, key: str, name: str = "employees", share: str = "percentage") -> DataFrame:
    """Rows per value of ``key`` with the share in all rows."""
    groups = df.groupBy(key).agg(F.count("*").alias(name))
    return with_share(groups, name, share).orderBy(F.desc(name), key)


def hires_per_year(employees: DataFrame) -> DataFrame:
    return (
        employees.groupBy(F.year("joining_date").alias("hire_year"))
        .agg(F.count("*").alias("new_hires"))
        .orderBy("hire_year")
    )


def active_by_location(employees: DataFrame) -> DataFrame:
    return by(employees.filter(is_active()), "location", "active_employees")
