"""Projects: staffing, billing, clients, duration, attrition, load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import day
from rollcall.functions.measures import is_exited, mean, rate, with_share
from rollcall.operators.ranking import top, top_ranked


def staffing(projects: DataFrame) -> DataFrame:
    return (
        projects.groupBy("project_name")
        .agg(F.count("*").alias("employees_assigned"))
        .orderBy(F.desc("employees_assigned"), "project_name")
    )


def billing_split(projects: DataFrame) -> DataFrame:
    kind = F.when(F.col("billable"), "Billable").otherwise("Non-Billable")
    groups = projects.groupBy("billable").agg(F.count("*").alias("assignments")).withColumn("billing_type", kind)
    return with_share(groups, "assignments", "percentage").select("billing_type", "assignments", "percentage")


def top_clients(projects: DataFrame, n: int = 15) -> DataFrame:
    clients = projects.groupBy("client_name").agg(
        F.count("*").alias("assignments"),
        F.countDistinct("project_name").alias("distinct_projects"),
        F.countDistinct("employee_id").alias("unique_employees"),
    )
    return top(clients, n, F.desc("assignments"), "client_name")


def durations(projects: DataFrame) -> DataFrame:
    """Finished assignments: mean length in days, first start, last end."""
    return (
        projects.filter(F.col("end_date").isNotNull())
        .groupBy("project_name")
        .agg(
            F.count("*").alias("team_size"),
            mean(F.datediff("end_date", "start_date"), 0).alias("avg_duration_days"),
            F.min("start_date").alias("earliest_start"),
            F.max("end_date").alias("latest_end"),
        )
        .orderBy(F.desc("avg_duration_days"), "project_name")
    )


def open_assignments(projects: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        projects.filter((F.col("end_date") >= day(as_of)) | F.col("end_date").isNull())
        .groupBy("project_name", "client_name")
        .agg(F.count("*").alias("active_assignments"), F.count_if("billable").alias("billable_count"))
        .orderBy(F.desc("active_assignments"), "project_name", "client_name")
    )


def attrition(projects: DataFrame, employees: DataFrame, n: int = 20) -> DataFrame:
    """Assignments of people who left, by project and client."""
    groups = (
        projects.select("employee_id", "project_name", "client_name")
        .join(employees.select("employee_id", "status"), "employee_id")
        .groupBy("project_name", "client_name")
        .agg(
            F.count("*").alias("total_assignments"),
            F.count_if(is_exited()).alias("exited_employees"),
            rate(is_exited()).alias("attrition_rate_pct"),
        )
    )
    return top(groups, n, F.desc("attrition_rate_pct"), "project_name", "client_name")


def workload(projects: DataFrame, employees: DataFrame, n: int = 20) -> DataFrame:
    load = projects.groupBy("employee_id").agg(F.countDistinct("project_name").alias("projects_worked_on"))
    staff = employees.select("employee_id", "department", "level")
    ranked = top_ranked(load.join(staff, "employee_id"), n, "projects_worked_on", "employee_id", "workload_rank")
    return ranked.select("employee_id", "department", "level", "projects_worked_on", "workload_rank")


def by_department(projects: DataFrame, employees: DataFrame) -> DataFrame:
    """Counted per department and project first, so distinct projects are rows of a small table."""
    return (
        projects.select("employee_id", "project_name", "billable")
        .join(employees.select("employee_id", "department"), "employee_id")
        .groupBy("department", "project_name")
        .agg(F.count("*").alias("_rows"), F.count_if("billable").alias("_billable"))
        .groupBy("department")
        .agg(
            F.count("project_name").alias("distinct_projects"),
            F.sum("_rows").alias("total_assignments"),
            F.sum("_billable").alias("billable_assignments"),
        )
        .orderBy(F.desc("total_assignments"), "department")
    )
