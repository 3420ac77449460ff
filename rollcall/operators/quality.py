"""Data-quality checks and the validation report.

All row checks of a table are counted in one pass; each foreign key adds one
anti join of distinct keys. A check is a row (section, check, passed,
violations, detail); the offending rows stay in the data and can be asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import day
from rollcall.schema import SALARY_BANDS

# --- Fixed values: required columns and allowed sets -------------------------
REQUIRED_COLUMNS = (
    "employee_id",
    "gender",
    "age",
    "location",
    "department",
    "role",
    "level",
    "joining_date",
    "college_tier",
    "manager_id",
    "status",
)
GENDERS = ("Male", "Female", "Other", "Non-binary")
EMPLOYEE_STATUSES = ("Active", "Inactive", "Exited")
PROMOTIONS = ("Yes", "No")
COURSE_STATUSES = ("Completed", "In Progress", "Not Started")
BILLABLE_WORDS = ("Yes", "No", "True", "False", "true", "false")
BOOLEAN_WORDS = ("True", "False", "true", "false", "1", "0")
AGES = (21, 60)
RATINGS = (1, 5)
REFERENCE = "Referential Integrity (Emp IDs)"
EXIT_ORDER = "Exit Date After Joining Date"
_EXIT_ORDER_TEXTS = ("All exit dates are after corresponding joining dates", "exits before joining date")
SECTIONS = {
    "employees": "1. Employees",
    "compensation": "2. Compensation",
    "performance": "3. Performance",
    "projects": "4. Projects",
    "learning": "5. Learning",
    "exits": "6. Exit Records",
}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class RowCheck:
    """A check that counts the rows for which ``violated`` is true."""

    id: str
    name: str
    violated: Column
    good: str
    bad: str


def _outside(condition: Column) -> Column:
    """Not met; a NULL counts as not met."""
    return ~F.coalesce(condition, F.lit(False))


def _text(value: str) -> str:
    escaped = value.replace("'", "\\'")
    return f"'{escaped}'"


def _row(section: str, name: str, count: str, good: str, bad: str) -> str:
    """A result as an SQL struct; ``good`` and ``bad`` are SQL expressions."""
    return (
        f"named_struct('section', {_text(section)}, 'check', {_text(name)}, 'passed', {count} = 0, "
        f"'violations', {count}, 'detail', CASE WHEN {count} = 0 THEN {good} ELSE {bad} END)"
    )


def _result(section: str, name: str, count: str, good: str, bad: str) -> str:
    return _row(section, name, count, _text(good), f"concat_ws(' ', {count}, {_text(bad)})")


def _inline(counted: DataFrame, rows: Sequence[str]) -> DataFrame:
    return counted.selectExpr(f"inline(array({', '.join(rows)}))")


def run_row_checks(df: DataFrame, section: str, checks: Sequence[RowCheck]) -> DataFrame:
    """All ``checks`` in one aggregate over ``df``, one row per check."""
    counted = df.agg(*[F.count_if(c.violated).alias(c.id) for c in checks])
    return _inline(counted, [_result(section, c.name, c.id, c.good, c.bad) for c in checks])


def _single(counted: DataFrame, section: str, name: str, good: str, bad: str) -> DataFrame:
    return _inline(counted, [_result(section, name, "n", good, bad)])


# --- checks that need more than one row at a time ----------------------------


def schema_check(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    # An aggregate over no rows reads no data and gives exactly one row.
    counted = df.limit(0).agg((F.count("*") + len(missing)).alias("n"))
    good, bad = f"{len(required)} required columns present", f"Missing columns: {missing}"
    return _inline(counted, [_row(SECTIONS["employees"], "Employee Schema", "n", _text(good), _text(bad))])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, and all rows."""
    groups = df.groupBy(key).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")
    )


def uniqueness_check(employees: DataFrame, key: str = "employee_id") -> DataFrame:
    good, bad = "concat(rows, ' unique IDs confirmed')", "concat('Duplicate IDs found: ', n)"
    row = _row(SECTIONS["employees"], "Employee ID Uniqueness", "n", good, bad)
    return _inline(duplicate_keys(employees, key), [row])


def null_counts(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """NULLs per column, one row per column."""
    have = [c for c in columns if c in df.columns]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in have])
    return counted.unpivot([], have, "column_name", "null_count")


def null_check(employees: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row: NULLs in the required columns; the detail lists the columns that have any."""
    have = [c for c in columns if c in employees.columns]
    counted = employees.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in have])
    listed = ", ".join(f"CASE WHEN `{c}` > 0 THEN concat('{c}: ', `{c}`) END" for c in have)
    total = "(" + " + ".join(f"`{c}`" for c in have) + ")"
    good, bad = _text("No null values in critical columns"), f"concat_ws(', ', {listed})"
    return _inline(counted, [_row(SECTIONS["employees"], "No Null Values", total, good, bad)])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Every different row once, with its number of copies as ``_n``."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column, as one count."""
    return distinct_rows(df).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")
    )


def assignments(projects: DataFrame) -> DataFrame:
    # A serial key would make every row distinct.
    return projects.drop("assignment_id")


def duplicate_row_check(projects: DataFrame) -> DataFrame:
    rows = assignments(projects)
    good, bad = "concat(rows, ' rows – no duplicates')", "concat(n, ' fully duplicate rows found')"
    row = _row(SECTIONS["projects"], "No Duplicate Assignment Rows", "n", good, bad)
    return _inline(duplicate_rows(rows), [row])


def orphan_keys(child: DataFrame, parent: DataFrame, key: str = "employee_id") -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` lacks."""
    return child.select(key).distinct().join(parent.select(key), key, "left_anti")


def reference_check(child: DataFrame, employees: DataFrame, table: str) -> DataFrame:
    counted = orphan_keys(child, employees).agg(F.count("*").alias("n"))
    return _single(counted, SECTIONS[table], REFERENCE, *_reference_texts(table))


_nouns = {
    "compensation": "compensation",
    "performance": "performance",
    "projects": "project",
    "learning": "learning",
    "exits": "exit",
}


def _reference_texts(table: str) -> tuple[str, str]:
    return f"All {_nouns[table]} records tied to valid employees", f"unknown employee IDs in {table}"


def band_violations(compensation: DataFrame, bands: DataFrame) -> DataFrame:
    """Rows outside the band, per level that has any; a missing salary counts."""
    inside = F.col("salary").between(F.col("band_min"), F.col("band_max"))
    return (
        compensation.select("level", "salary")
        .join(F.broadcast(bands), "level")
        .groupBy("level", "band_min", "band_max")
        .agg(F.count_if(_outside(inside)).alias("violations"))
        .filter("violations > 0")
    )


def band_check(compensation: DataFrame, bands: DataFrame, n_bands: int = len(SALARY_BANDS)) -> DataFrame:
    # One row per level at most, so listing them in one line is safe.
    line = F.format_string("%s: %d records outside band", F.col("level"), F.col("violations"))
    totals = band_violations(compensation, bands).agg(
        F.coalesce(F.sum("violations"), F.lit(0)).alias("n"), F.sort_array(F.collect_list(line)).alias("lines")
    )
    good, bad = _text(f"All {n_bands} bands compliant"), "concat_ws('; ', lines)"
    return _inline(totals, [_row(SECTIONS["compensation"], "Salary Band Compliance", "n", good, bad)])


def exit_order_check(exits: DataFrame, employees: DataFrame) -> DataFrame:
    """Exits dated before the employee joined."""
    counted = (
        exits.select("employee_id", "exit_date")
        .join(employees.select("employee_id", "joining_date"), "employee_id", "left")
        .agg(F.count_if(F.col("exit_date") < F.col("joining_date")).alias("n"))
    )
    return _single(counted, SECTIONS["exits"], EXIT_ORDER, *_EXIT_ORDER_TEXTS)


def offenders(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed set with their row counts."""
    bad = df.filter(_outside(F.col(column).cast("string").isin(*allowed)))
    return bad.groupBy(column).agg(F.count("*").alias("row_count"))


# --- row checks per table ----------------------------------------------------


def employee_checks(as_of: dt.date, genders=GENDERS, statuses=EMPLOYEE_STATUSES) -> list[RowCheck]:
    c = F.col
    return [
        RowCheck(
            "e4",
            "Age Range (21–60)",
            _outside(c("age").between(*AGES)),
            "All ages within [21, 60]",
            "out-of-range records",
        ),
        RowCheck(
            "e5",
            "Gender Values",
            _outside(c("gender").isin(*genders)),
            "Allowed gender set respected",
            "records with invalid values",
        ),
        RowCheck(
            "e6",
            "Joining Date (No Future)",
            c("joining_date") > day(as_of),
            "All joining dates are historical",
            "future-dated records",
        ),
        RowCheck(
            "e7",
            "Employee Status Values",
            _outside(c("status").isin(*statuses)),
            "All statuses valid",
            "records with invalid statuses",
        ),
    ]


def compensation_checks(as_of: dt.date) -> list[RowCheck]:
    c = F.col
    return [
        RowCheck("c1", "No Negative Salary", c("salary") < 0, "All salaries ≥ 0", "records with negative salary"),
        RowCheck("c2", "No Negative Bonus", c("bonus") < 0, "All bonuses ≥ 0", "records with negative bonus"),
        RowCheck(
            "c4",
            "Effective Date (No Future)",
            c("effective_date") > day(as_of),
            "All effective dates are historical",
            "future-dated records",
        ),
    ]


def performance_checks(as_of: dt.date) -> list[RowCheck]:
    c = F.col
    return [
        RowCheck(
            "p1",
            "Performance Rating (1–5)",
            _outside(c("rating").between(*RATINGS)),
            "All ratings within [1, 5]",
            "out-of-range ratings",
        ),
        RowCheck(
            "p2",
            "Review Year (No Future)",
            c("review_year") > as_of.year,
            f"All review years ≤ {as_of.year}",
            "records with future review year",
        ),
        RowCheck(
            "p4",
            "Promotion Values (Yes/No)",
            _outside(c("promotion").isin(*PROMOTIONS)),
            "All promotion flags are Yes/No",
            "records with invalid values",
        ),
    ]


def project_checks(as_of: dt.date) -> list[RowCheck]:
    c = F.col
    return [
        RowCheck(
            "j2",
            "Project Date Order (end ≥ start)",
            c("end_date") < c("start_date"),
            "All project dates are logically ordered",
            "projects with end_date < start_date",
        ),
        RowCheck(
            "j3",
            "Project Start Date (No Future)",
            c("start_date") > day(as_of),
            "All project start dates are historical",
            "projects with future start_date",
        ),
        RowCheck(
            "j4",
            "Billable Flag (Yes/No/Bool)",
            _outside(c("billable").cast("string").isin(*BILLABLE_WORDS)),
            "All billable flags are valid (Yes/No or True/False)",
            "records with invalid values",
        ),
    ]


def learning_checks(as_of: dt.date) -> list[RowCheck]:
    c = F.col
    return [
        RowCheck(
            "l1",
            "Learning Hours (≥ 0)",
            c("hours_completed") < 0,
            "All learning hours are non-negative",
            "records with negative hours",
        ),
        RowCheck(
            "l2",
            "Completion Status Values",
            _outside(c("completion_status").isin(*COURSE_STATUSES)),
            "All statuses within the allowed set",
            "records with invalid values",
        ),
        RowCheck(
            "l3",
            "Completion Date (No Future)",
            c("completion_date") > day(as_of),
            "All completion dates are historical",
            "future completion dates",
        ),
    ]


def exit_checks(as_of: dt.date) -> list[RowCheck]:
    c = F.col
    return [
        RowCheck(
            "x3",
            "Exit Date (No Future)",
            c("exit_date") > day(as_of),
            "All exit dates are historical",
            "future-dated exits",
        ),
        RowCheck(
            "x4",
            "Exit Reason Not Blank",
            c("exit_reason").isNull() | (F.trim("exit_reason") == ""),
            "All exit records have a reason",
            "records with blank exit_reason",
        ),
        RowCheck(
            "x5",
            "Voluntary Flag (Boolean)",
            _outside(c("voluntary").cast("string").isin(*BOOLEAN_WORDS)),
            "All voluntary flags are boolean",
            "records with invalid voluntary flag",
        ),
    ]


ROW_CHECKS = {
    "employees": employee_checks,
    "compensation": compensation_checks,
    "performance": performance_checks,
    "projects": project_checks,
    "learning": learning_checks,
    "exits": exit_checks,
}


def row_check(df: DataFrame, table: str, check_id: str, as_of: dt.date) -> DataFrame:
    """One row check on its own; only its columns are read."""
    chosen = [c for c in ROW_CHECKS[table](as_of) if c.id == check_id]
    return run_row_checks(df, SECTIONS[table], chosen)


def table_checks(df: DataFrame, employees: DataFrame, table: str, as_of: dt.date, copies: str | None = None) -> DataFrame:
    """All row checks of a history table and its foreign key from one scan.

    Violations are counted per employee first. That leaves the distinct keys,
    which then meet the distinct employees once. ``copies`` names a column that
    says how many rows a row stands for.
    """
    checks = ROW_CHECKS[table](as_of)
    section = SECTIONS[table]
    known = employees.select("employee_id").distinct().withColumn("_known", F.lit(True))
    rows = F.col(copies) if copies else F.lit(1)
    keyed = df.groupBy("employee_id").agg(*[F.sum(F.when(c.violated, rows).otherwise(0)).alias(c.id) for c in checks])
    totals = keyed.join(known, "employee_id", "left").agg(
        *[F.coalesce(F.sum(c.id), F.lit(0)).alias(c.id) for c in checks],
        F.count_if(F.col("_known").isNull()).alias("fk"),
    )
    rows = [_result(section, c.name, c.id, c.good, c.bad) for c in checks]
    return _inline(totals, [*rows, _result(section, REFERENCE, "fk", *_reference_texts(table))])


def validation_report(tables: Mapping[str, DataFrame], bands: DataFrame, as_of: dt.date) -> DataFrame:
    """All 30 checks as rows."""
    employees = tables["employees"]
    parts = [
        schema_check(employees),
        uniqueness_check(employees),
        null_check(employees),
        run_row_checks(employees, SECTIONS["employees"], employee_checks(as_of)),
        band_check(tables["compensation"], bands),
        duplicate_row_check(tables["projects"]),
        exit_order_check(tables["exits"], employees),
    ]
    # The rows the duplicate check has grouped: Spark reuses that exchange, so the table is joined and shuffled once.
    grouped = distinct_rows(assignments(tables["projects"]))
    parts += [
        table_checks(grouped, employees, t, as_of, "_n") if t == "projects" else table_checks(tables[t], employees, t, as_of)
        for t in ROW_CHECKS
        if t != "employees"
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def totals(report: DataFrame) -> DataFrame:
    """Checks run, passed and failed."""
    return report.agg(
        F.count("*").alias("checks_run"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def all_passed(report: DataFrame) -> bool:
    """The gate: True when no check failed."""
    return report.filter(~F.col("passed")).isEmpty()
