"""Registered queries: data-quality checks and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators import audit, quality
from rollcall.plans.bound import Bound
from rollcall.plans.oracle import AS_OF, dbl, half_even, half_up, mean_int, mean_money

EMPLOYEE_COLUMNS = len(quality.REQUIRED_COLUMNS)


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _result(section: str, name: str, count: str, good: str, bad: str) -> str:
    return (
        f"SELECT '{quality.SECTIONS[section]}' AS section, '{name}' AS \"check\", n = 0 AS passed, "
        f"CAST(n AS BIGINT) AS violations, CASE WHEN n = 0 THEN {good} ELSE {bad} END AS detail FROM ({count}) c"
    )


def _row_sql(section: str, name: str, violated: str, good: str, bad: str) -> str:
    count = f"SELECT count(*) FILTER (WHERE {violated}) AS n FROM {section}"
    return _result(section, name, count, f"'{good}'", f"n || ' {bad}'")


def _orphans_sql(table: str, noun: str) -> str:
    count = (
        f"SELECT count(*) AS n FROM (SELECT DISTINCT employee_id FROM {table}) t "
        "WHERE employee_id NOT IN (SELECT employee_id FROM employees)"
    )
    return _result(
        table,
        "Referential Integrity (Emp IDs)",
        count,
        f"'All {noun} records tied to valid employees'",
        f"n || ' unknown employee IDs in {table}'",
    )


def _no(condition: str) -> str:
    return f"NOT coalesce({condition}, false)"


def _freq_sql(column: str, table: str) -> str:
    total = "CAST(sum(count(*)) OVER () AS HUGEINT)"
    return (
        f"SELECT '{column}' AS attribute, CAST({column} AS VARCHAR) AS value, count(*) AS row_count, "
        f"{half_even('count(*)', total, 2, 100)} AS share_pct FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
    )


def _row(table: str, check: str):
    return lambda b: quality.row_check(getattr(b, table), table, check, b.as_of)


def _reference(table: str):
    return lambda b: quality.reference_check(getattr(b, table), b.employees, table)


_null_terms = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in quality.REQUIRED_COLUMNS)
_null_list = ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN '{c}: ' || count(*) FILTER (WHERE {c} IS NULL) END"
    for c in quality.REQUIRED_COLUMNS
)
_bands = """SELECT c.level, count(*) FILTER (WHERE NOT coalesce(salary BETWEEN band_min AND band_max, false)) AS v
FROM compensation c JOIN bands b ON b.level = c.level GROUP BY c.level"""

SQL = {
    "e1_schema": (
        f"SELECT '{quality.SECTIONS['employees']}' AS section, 'Employee Schema' AS \"check\", true AS passed, "
        f"CAST(0 AS BIGINT) AS violations, '{EMPLOYEE_COLUMNS} required columns present' AS detail"
    ),
    "e2_unique_key": _result(
        "employees",
        "Employee ID Uniqueness",
        "SELECT count(*) - count(DISTINCT employee_id) AS n, count(*) AS r FROM employees",
        "r || ' unique IDs confirmed'",
        "'Duplicate IDs found: ' || n",
    ),
    "e3_no_nulls": _result(
        "employees",
        "No Null Values",
        f"SELECT {_null_terms} AS n, concat_ws(', ', {_null_list}) AS listed FROM employees",
        "'No null values in critical columns'",
        "listed",
    ),
    "e4_age_range": _row_sql(
        "employees",
        "Age Range (21–60)",
        _no("age BETWEEN 21 AND 60"),
        "All ages within [21, 60]",
        "out-of-range records",
    ),
    "e5_gender_values": _row_sql(
        "employees",
        "Gender Values",
        _no(f"gender IN ({_quoted(quality.GENDERS)})"),
        "Allowed gender set respected",
        "records with invalid values",
    ),
    "e6_joining_date": _row_sql(
        "employees",
        "Joining Date (No Future)",
        f"joining_date > {AS_OF}",
        "All joining dates are historical",
        "future-dated records",
    ),
    "e7_status_values": _row_sql(
        "employees",
        "Employee Status Values",
        _no(f"status IN ({_quoted(quality.EMPLOYEE_STATUSES)})"),
        "All statuses valid",
        "records with invalid statuses",
    ),
    "c1_salary_sign": _row_sql(
        "compensation", "No Negative Salary", "salary < 0", "All salaries ≥ 0", "records with negative salary"
    ),
    "c2_bonus_sign": _row_sql(
        "compensation", "No Negative Bonus", "bonus < 0", "All bonuses ≥ 0", "records with negative bonus"
    ),
    "c3_salary_band": _result(
        "compensation",
        "Salary Band Compliance",
        "SELECT coalesce(sum(v), 0) AS n, string_agg(level || ': ' || v || ' records outside band', '; ' "
        f"ORDER BY level) AS listed FROM ({_bands}) x WHERE v > 0",
        "'All 5 bands compliant'",
        "listed",
    ),
    "c4_effective_date": _row_sql(
        "compensation",
        "Effective Date (No Future)",
        f"effective_date > {AS_OF}",
        "All effective dates are historical",
        "future-dated records",
    ),
    "c5_employee_exists": _orphans_sql("compensation", "compensation"),
    "p1_rating_range": _row_sql(
        "performance",
        "Performance Rating (1–5)",
        _no("rating BETWEEN 1 AND 5"),
        "All ratings within [1, 5]",
        "out-of-range ratings",
    ),
    "p2_review_year": _row_sql(
        "performance",
        "Review Year (No Future)",
        "review_year > 2001",
        "All review years ≤ 2001",
        "records with future review year",
    ),
    "p3_employee_exists": _orphans_sql("performance", "performance"),
    "p4_promotion_values": _row_sql(
        "performance",
        "Promotion Values (Yes/No)",
        _no("promotion IN ('Yes', 'No')"),
        "All promotion flags are Yes/No",
        "records with invalid values",
    ),
    "j1_duplicate_rows": _result(
        "projects",
        "No Duplicate Assignment Rows",
        "SELECT sum(c) - count(*) AS n, CAST(sum(c) AS BIGINT) AS r FROM (SELECT count(*) AS c FROM projects "
        "GROUP BY employee_id, project_name, client_name, start_date, end_date, billable) g",
        "r || ' rows – no duplicates'",
        "n || ' fully duplicate rows found'",
    ),
    "j2_date_order": _row_sql(
        "projects",
        "Project Date Order (end ≥ start)",
        "end_date < start_date",
        "All project dates are logically ordered",
        "projects with end_date < start_date",
    ),
    "j3_start_date": _row_sql(
        "projects",
        "Project Start Date (No Future)",
        f"start_date > {AS_OF}",
        "All project start dates are historical",
        "projects with future start_date",
    ),
    "j4_billable_values": _row_sql(
        "projects",
        "Billable Flag (Yes/No/Bool)",
        _no("CAST(billable AS VARCHAR) IN ('Yes', 'No', 'true', 'false')"),
        "All billable flags are valid (Yes/No or True/False)",
        "records with invalid values",
    ),
    "j5_employee_exists": _orphans_sql("projects", "project"),
    "l1_hours_sign": _row_sql(
        "learning",
        "Learning Hours (≥ 0)",
        "hours_completed < 0",
        "All learning hours are non-negative",
        "records with negative hours",
    ),
    "l2_status_values": _row_sql(
        "learning",
        "Completion Status Values",
        _no(f"completion_status IN ({_quoted(quality.COURSE_STATUSES)})"),
        "All statuses within the allowed set",
        "records with invalid values",
    ),
    "l3_completion_date": _row_sql(
        "learning",
        "Completion Date (No Future)",
        f"completion_date > {AS_OF}",
        "All completion dates are historical",
        "future completion dates",
    ),
    "l4_employee_exists": _orphans_sql("learning", "learning"),
    "x1_employee_exists": _orphans_sql("exits", "exit"),
    "x2_exit_after_joining": _result(
        "exits",
        "Exit Date After Joining Date",
        "SELECT count(*) FILTER (WHERE exit_date < joining_date) AS n FROM exits "
        "LEFT JOIN employees USING (employee_id)",
        "'All exit dates are after corresponding joining dates'",
        "n || ' exits before joining date'",
    ),
    "x3_exit_date": _row_sql(
        "exits",
        "Exit Date (No Future)",
        f"exit_date > {AS_OF}",
        "All exit dates are historical",
        "future-dated exits",
    ),
    "x4_reason_given": _row_sql(
        "exits",
        "Exit Reason Not Blank",
        "exit_reason IS NULL OR trim(exit_reason) = ''",
        "All exit records have a reason",
        "records with blank exit_reason",
    ),
    "x5_voluntary_flag": _row_sql(
        "exits",
        "Voluntary Flag (Boolean)",
        _no("CAST(voluntary AS VARCHAR) IN ('true', 'false')"),
        "All voluntary flags are boolean",
        "records with invalid voluntary flag",
    ),
}


def _report(b: Bound):
    return quality.validation_report(b.t.tables(), b.bands, b.as_of)


_REPORT_SQL = " UNION ALL ".join(f"SELECT * FROM ({sql}) r" for sql in SQL.values())

BUILDERS = {
    "e1_schema": lambda b: quality.schema_check(b.employees),
    "e2_unique_key": lambda b: quality.uniqueness_check(b.employees),
    "e3_no_nulls": lambda b: quality.null_check(b.employees),
    "e4_age_range": _row("employees", "e4"),
    "e5_gender_values": _row("employees", "e5"),
    "e6_joining_date": _row("employees", "e6"),
    "e7_status_values": _row("employees", "e7"),
    "c1_salary_sign": _row("compensation", "c1"),
    "c2_bonus_sign": _row("compensation", "c2"),
    "c3_salary_band": lambda b: quality.band_check(b.compensation, b.bands),
    "c4_effective_date": _row("compensation", "c4"),
    "c5_employee_exists": _reference("compensation"),
    "p1_rating_range": _row("performance", "p1"),
    "p2_review_year": _row("performance", "p2"),
    "p3_employee_exists": _reference("performance"),
    "p4_promotion_values": _row("performance", "p4"),
    "j1_duplicate_rows": lambda b: quality.duplicate_row_check(b.projects),
    "j2_date_order": _row("projects", "j2"),
    "j3_start_date": _row("projects", "j3"),
    "j4_billable_values": _row("projects", "j4"),
    "j5_employee_exists": _reference("projects"),
    "l1_hours_sign": _row("learning", "l1"),
    "l2_status_values": _row("learning", "l2"),
    "l3_completion_date": _row("learning", "l3"),
    "l4_employee_exists": _reference("learning"),
    "x1_employee_exists": _reference("exits"),
    "x2_exit_after_joining": lambda b: quality.exit_order_check(b.exits, b.employees),
    "x3_exit_date": _row("exits", "x3"),
    "x4_reason_given": _row("exits", "x4"),
    "x5_voluntary_flag": _row("exits", "x5"),
}

QUERIES = {name: (build, SQL[name]) for name, build in BUILDERS.items()}
QUERIES |= {
    "dq1_validation_report": (_report, _REPORT_SQL),
    "dq1_validation_totals": (
        lambda b: quality.totals(_report(b)),
        "SELECT count(*) AS checks_run, count(*) FILTER (WHERE passed) AS passed, "
        f"count(*) FILTER (WHERE NOT passed) AS failed FROM ({_REPORT_SQL}) a",
    ),
    "a1_attrition_shares": (lambda b: audit.attrition_shares(b.employees), _freq_sql("status", "employees")),
    "a1_exit_share": (
        lambda b: audit.exit_share(b.employees, b.exits),
        f"SELECT count(*) AS exits, {half_up('count(*)', '(SELECT count(*) FROM employees)', 2, 100)} AS share_pct "
        "FROM exits",
    ),
    "a2_rating_shares": (lambda b: audit.rating_shares(b.performance), _freq_sql("rating", "performance")),
    "a3_band_targets": (
        lambda b: audit.band_targets(b.compensation, b.bands),
        f"SELECT c.level, {dbl('band_min')} AS band_min, {dbl('band_max')} AS band_max, {dbl('lo')} AS min_actual, "
        f"{dbl('hi')} AS max_actual, lo < band_min OR hi > band_max AS has_drift FROM (SELECT level, min(salary) AS lo, "
        "max(salary) AS hi FROM compensation GROUP BY level) c JOIN bands b ON b.level = c.level",
    ),
    "a4_learning_profile": (
        lambda b: audit.learning_profile(b.learning),
        f"{_freq_sql('skill_category', 'learning')} UNION ALL {_freq_sql('completion_status', 'learning')}",
    ),
    "a5_project_profile": (
        lambda b: audit.project_profile(b.projects),
        f"{_freq_sql('client_name', 'projects')} UNION ALL {_freq_sql('billable', 'projects')}",
    ),
    "a6_team_sizes": (
        lambda b: audit.team_sizes(b.employees),
        f"SELECT {mean_int('n')} AS avg_team_size, min(n) AS min_team_size, max(n) AS max_team_size FROM "
        "(SELECT count(*) AS n FROM employees WHERE status = 'Active' AND manager_id IS NOT NULL "
        "GROUP BY manager_id) t",
    ),
    "a7_exit_profile": (
        lambda b: audit.exit_profile(b.exits),
        f"{_freq_sql('exit_reason', 'exits')} UNION ALL {_freq_sql('voluntary', 'exits')}",
    ),
    "a8_salary_profile": (
        lambda b: _rounded_std(audit.salary_profile(b.compensation)),
        f"SELECT 'salary' AS column_name, count(*) AS \"count\", {dbl('sum(salary)')} / count(*) AS mean, "
        f"round(stddev_samp({dbl('salary')}), 4) AS std, {dbl('min(salary)')} AS min, {dbl('max(salary)')} AS max, "
        f"quantile_cont({dbl('salary')}, 0.25) AS q1, quantile_cont({dbl('salary')}, 0.5) AS median, "
        f"quantile_cont({dbl('salary')}, 0.75) AS q3 FROM compensation",
    ),
    "a8_salary_by_level": (
        lambda b: audit.salary_by_level(b.compensation),
        f"SELECT level, {mean_money('salary', 2, half_even)} AS avg_salary FROM compensation GROUP BY level",
    ),
}


def _rounded_std(df):
    """The last digits of a sample deviation depend on the order of summation."""
    return df.withColumn("std", F.round("std", 4))
