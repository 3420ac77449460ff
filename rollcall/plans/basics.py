"""Registered queries: sources and sinks, relational and scalar operators."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from rollcall.functions import buckets, dates
from rollcall.functions.measures import is_exited, rate
from rollcall.functions.picks import first_value, last_value, newest
from rollcall.operators import audit, dashboard, headcount, quality, ranking, relational
from rollcall.operators.quantiles import describe, exact_quantiles
from rollcall.plans.bound import Bound
from rollcall.plans.oracle import AS_OF, LATEST, big, dbl, half_even, rate as rate_sql, tenure, where, years
from rollcall.plans.checks import SQL as CHECKS
from rollcall.plans.risk import _FLAGS, CARD_BASE, CARD_FEATURES, card
from rollcall.riskmodel import ensemble, features
from rollcall.schema import REQUIRED
from rollcall.sources import readers, sinks
from rollcall.sources.scratch import scratch_folder

_EMPLOYEES = f"SELECT * REPLACE ({big('age')} AS age) FROM employees"
_EXITED = "status = 'Exited'"
_LATEST = f"({LATEST})"


def _folder(b: Bound, name: str) -> str:
    return f"{scratch_folder(b.spark)}/rollcall/{name}-{uuid.uuid4().hex}"


def _csv_folder(b: Bound, *names: str) -> str:
    """The named tables written as CSV in the layout the reader expects."""
    folder = _folder(b, "csv")
    for name in names:
        sinks.save_dataframe(getattr(b, name), f"{folder}/{readers.FILES[name]}.csv", "csv")
    return folder


def _read_employees(b: Bound):
    return readers.read_table(b.spark, "employees", _csv_folder(b, "employees"))


def _load_raw(b: Bound):
    return readers.dataset_profile(readers.load_raw(b.spark, _csv_folder(b, *REQUIRED)))


def _missing(b: Bound):
    """Datasets found and missing after writing two of the six."""
    folder = _csv_folder(b, "employees", "exits")
    gone = readers.missing_datasets(b.spark, folder)
    return b.employees.groupBy(F.lit(True).alias("checked")).agg(
        F.count("*").alias("row_count"), F.lit(", ".join(gone)).alias("missing")
    )


def _lenient(b: Bound):
    """Dates as text, one in five damaged."""
    text = F.when(F.col("employee_id") % 5 == 0, "not a date").otherwise(F.col("joining_date").cast("string"))
    return b.employees.select("employee_id", dates.lenient_date(text).alias("joining_date"))


def _saved_tables(b: Bound):
    prefix = f"rc_{uuid.uuid4().hex[:8]}_"
    tables = {n: getattr(b, n) for n in ("managers", "exits")}
    names = sinks.save_tables(tables, prefix=prefix, location=_folder(b, "tables"))
    return readers.dataset_profile({n.removeprefix(prefix): b.spark.table(n) for n in names})


def _views(b: Bound):
    sinks.create_views(
        b.spark, dashboard.views(b.employees, b.compensation, b.performance, b.exits, b.as_of)
    )
    return b.spark.sql(
        "SELECT k.department, k.attrition_rate_pct, count(*) AS paid_staff FROM vw_dept_kpis k "
        "JOIN vw_employee_360 e ON e.department = k.department GROUP BY k.department, k.attrition_rate_pct"
    )


def _report_file(b: Bound):
    path = sinks.save_report(
        quality.run_row_checks(b.employees, "1. Employees", quality.employee_checks(b.as_of)),
        _folder(b, "report"),
        dt.datetime(2001, 8, 2),
    )
    return b.spark.read.schema("section string, check string, passed boolean, detail string, generated_at string").json(
        path
    )


def _metrics_file(b: Bound):
    row = b.employees.agg(F.count("*").alias("rows"), rate(is_exited()).alias("attrition_rate_pct"))
    return b.spark.read.schema("rows bigint, attrition_rate_pct double").json(
        sinks.save_metrics(row, _folder(b, "metrics"))
    )


def _saved_model(b: Bound):
    path = sinks.save_model(card(b), CARD_FEATURES, CARD_BASE, _folder(b, "model"))
    table, columns, base = sinks.load_model(b.spark, path)
    return ensemble.score(b.matrix, table, base).agg(
        F.count("*").alias("row_count"),
        F.lit(len(columns)).alias("feature_count"),
        F.round(F.avg("prob"), 6).alias("mean_prob"),
    )


def _profile_sql(*names: str) -> str:
    columns = {
        "employees": 11,
        "managers": 4,
        "compensation": 7,
        "performance": 5,
        "projects": 6,
        "learning": 6,
        "exits": 4,
    }
    return " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS row_count, CAST({columns[n]} AS BIGINT) AS column_count FROM {n}"
        for n in names
    )


# Column counts after reading by schema: serial keys are added where the file has none.
_TYPED = {"employees": 11, "compensation": 7, "performance": 5, "projects": 7, "learning": 7, "exits": 5}

QUERIES = {
    # --- sources and sinks ---
    "s1_read_table": (_read_employees, _EMPLOYEES),
    "s2_load_raw": (
        _load_raw,
        " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, count(*) AS row_count, CAST({k} AS BIGINT) AS column_count FROM {n}"
            for n, k in _TYPED.items()
        ),
    ),
    "s3_lenient_dates": (
        _lenient,
        "SELECT employee_id, CASE WHEN employee_id % 5 = 0 THEN NULL ELSE joining_date END AS joining_date "
        "FROM employees",
    ),
    "s4_required_datasets": (
        _missing,
        "SELECT true AS checked, count(*) AS row_count, 'compensation, performance, projects, learning' AS missing "
        "FROM employees",
    ),
    "s5_dataset_profile": (
        lambda b: readers.dataset_profile({n: getattr(b, n) for n in REQUIRED}),
        _profile_sql(*REQUIRED),
    ),
    "s6_csv_sink": (
        lambda b: readers.read_table(b.spark, "exits", _csv_folder(b, "exits")).drop("exit_id"),
        "SELECT * FROM exits",
    ),
    "s7_save_tables": (_saved_tables, _profile_sql("managers", "exits")),
    "s8_fixed_schemas": (
        lambda b: readers.conform(b.managers, "managers"),
        "SELECT manager_id, department, location, CAST(NULL AS BIGINT) AS team_size, "
        f"{big('experience_years')} AS experience_years FROM managers",
    ),
    "s9_named_views": (
        _views,
        f"SELECT department, {rate_sql(_EXITED)} AS attrition_rate_pct, "
        "CAST(sum(n) AS BIGINT) AS paid_staff FROM employees JOIN (SELECT employee_id, count(*) AS n "
        "FROM performance GROUP BY employee_id) p USING (employee_id) GROUP BY department",
    ),
    "s10_report_sink": (
        _report_file,
        " UNION ALL ".join(
            f"SELECT section, \"check\", passed, detail, '2001-08-02T00:00:00' AS generated_at FROM ({CHECKS[n]}) c"
            for n in ("e4_age_range", "e5_gender_values", "e6_joining_date", "e7_status_values")
        ),
    ),
    "s11_metrics_sink": (
        _metrics_file,
        f"SELECT count(*) AS rows, {rate_sql(_EXITED)} AS attrition_rate_pct FROM employees",
    ),
    "s12_model_file": (
        _saved_model,
        f"SELECT count(*) AS row_count, CAST({len(CARD_FEATURES)} AS BIGINT) AS feature_count, round(avg(prob), 6) AS mean_prob FROM carded",
    ),
    # --- relational operators ---
    "r1_projection": (
        lambda b: relational.project(
            b.compensation,
            [
                "comp_id",
                (F.col("salary") + F.col("bonus") + F.col("stock")).alias("total_pay"),
                (F.col("salary") * 2 - 1).alias("twice_less_one"),
            ],
        ),
        f"SELECT comp_id, {dbl('salary + bonus + stock')} AS total_pay, {dbl('salary * 2 - 1')} AS twice_less_one "
        "FROM compensation",
    ),
    "r2_filter": (
        lambda b: b.projects.filter(
            (F.col("end_date").isNull() | (F.col("end_date") >= dates.day(b.as_of)))
            & (F.col("billable") == True)  # noqa: E712
            & (F.col("start_date") < dates.day(b.as_of))
        ),
        f"SELECT * FROM projects WHERE (end_date IS NULL OR end_date >= {AS_OF}) AND billable "
        f"AND start_date < {AS_OF}",
    ),
    "r3_in_and_between": (
        lambda b: b.employees.filter(F.col("gender").isin("Female", "Non-binary") & F.col("age").between(30, 40)),
        f"{_EMPLOYEES} WHERE gender IN ('Female', 'Non-binary') AND age BETWEEN 30 AND 40",
    ),
    "r4_inner_join": (
        lambda b: b.learning.join(b.employees.select("employee_id", "department"), "employee_id"),
        "SELECT l.*, department FROM learning l JOIN employees e USING (employee_id)",
    ),
    "r5_left_join": (
        lambda b: b.employees.select("employee_id", "status").join(b.exits, "employee_id", "left"),
        "SELECT employee_id, status, exit_date, exit_reason, voluntary FROM employees LEFT JOIN exits USING (employee_id)",
    ),
    "r6_scalar_beside_rows": (
        lambda b: b.employees.groupBy("location").agg(rate(is_exited()).alias("local_pct")).withColumn(
            "company_pct", b.employees.agg(rate(is_exited()).alias("r")).scalar()
        ),
        f"SELECT location, {rate_sql(_EXITED)} AS local_pct, (SELECT {rate_sql(_EXITED)} FROM employees) AS company_pct "
        "FROM employees GROUP BY location",
    ),
    "r7_anti_join": (
        lambda b: relational.set_difference(b.compensation, b.exits, "employee_id"),
        "SELECT DISTINCT employee_id FROM compensation WHERE employee_id NOT IN (SELECT employee_id FROM exits)",
    ),
    "r8_full_outer_align": (
        lambda b: relational.align(
            headcount.hires_per_year(b.employees).withColumnRenamed("hire_year", "year"),
            b.exits.groupBy(F.year("exit_date").alias("year")).agg(F.count("*").alias("exits")),
            "year",
        ),
        "SELECT year, new_hires, exits FROM (SELECT year(joining_date) AS year, count(*) AS new_hires FROM employees "
        "GROUP BY 1) h FULL JOIN (SELECT year(exit_date) AS year, count(*) AS exits FROM exits GROUP BY 1) x USING (year)",
    ),
    "r9_aggregates": (
        lambda b: relational.totals(b.compensation, "level", "salary"),
        f"SELECT level, count(*) AS row_count, {dbl('sum(salary)')} AS total, {dbl('sum(salary)')} / count(salary) "
        f"AS average, {dbl('min(salary)')} AS least, {dbl('max(salary)')} AS greatest FROM compensation GROUP BY level",
    ),
    "r10_sample_deviation": (
        lambda b: b.compensation.groupBy("level").agg(F.round(F.stddev_samp("salary"), 4).alias("deviation")),
        f"SELECT level, round(stddev_samp({dbl('salary')}), 4) AS deviation FROM compensation GROUP BY level",
    ),
    "r11_count_distinct": (
        lambda b: b.projects.groupBy("client_name").agg(
            F.countDistinct("project_name").alias("projects"), F.countDistinct("employee_id").alias("people")
        ),
        "SELECT client_name, count(DISTINCT project_name) AS projects, count(DISTINCT employee_id) AS people "
        "FROM projects GROUP BY client_name",
    ),
    "r12_conditional_sum": (
        lambda b: b.learning.groupBy("skill_category").agg(
            F.sum(F.when(F.col("completion_status") == "Completed", F.col("hours_completed")).otherwise(0.0)).alias(
                "completed_hours"
            ),
            F.expr("count(*) FILTER (WHERE completion_date IS NULL)").alias("running"),
        ),
        "SELECT skill_category, sum(CASE WHEN completion_status = 'Completed' THEN hours_completed ELSE 0.0 END) "
        f"AS completed_hours, {where('completion_date IS NULL')} AS running FROM learning GROUP BY skill_category",
    ),
    "r13_having": (
        lambda b: relational.having(b.performance, "employee_id", 12),
        "SELECT employee_id, count(*) AS row_count FROM performance GROUP BY employee_id HAVING count(*) > 12",
    ),
    "r14_group_by_alias": (
        lambda b: relational.group_by_alias(b.employees, "year(joining_date)", "hire_year"),
        "SELECT year(joining_date) AS hire_year, count(*) AS row_count FROM employees GROUP BY hire_year",
    ),
    "r15_first_last_value": (
        lambda b: b.projects.groupBy("employee_id").agg(
            first_value("end_date", F.unix_date("start_date")).isNull().alias("never_ended"),
            F.min(F.when(F.col("end_date").isNotNull(), F.col("start_date"))).alias("first_ended_start"),
            last_value(F.col("start_date"), F.unix_date("start_date")).alias("last_start"),
        ),
        "SELECT employee_id, count(end_date) = 0 AS never_ended, min(start_date) FILTER (WHERE end_date IS NOT NULL) "
        "AS first_ended_start, max(start_date) AS last_start FROM projects GROUP BY employee_id",
    ),
    "r16_exact_median": (
        lambda b: exact_quantiles(b.compensation, ["salary", "bonus"], {"median": 0.5}),
        f"SELECT 'salary' AS column_name, median({dbl('salary')}) AS median FROM compensation UNION ALL "
        f"SELECT 'bonus', median({dbl('bonus')}) FROM compensation",
    ),
    "r17_describe": (
        lambda b: describe(b.learning, "hours_completed").withColumn("std", F.round("std", 6)),
        "SELECT 'hours_completed' AS column_name, count(*) AS \"count\", sum(hours_completed) / count(*) AS mean, "
        "round(stddev_samp(hours_completed), 6) AS std, min(hours_completed) AS min, max(hours_completed) AS max, "
        "quantile_cont(hours_completed, 0.25) AS q1, quantile_cont(hours_completed, 0.5) AS median, "
        "quantile_cont(hours_completed, 0.75) AS q3 FROM learning",
    ),
    "r18_frequencies": (
        lambda b: audit.frequencies(b.employees, "location"),
        "SELECT 'location' AS attribute, location AS value, count(*) AS row_count, "
        f"{half_even('count(*)', 'CAST(sum(count(*)) OVER () AS HUGEINT)', 2, 100)} AS share_pct "
        "FROM employees GROUP BY location",
    ),
    "r19_row_number": (
        lambda b: ranking.grouped_row_number(
            b.compensation.select("employee_id", "comp_id", "effective_date"),
            "employee_id",
            F.desc("effective_date"),
            F.desc("comp_id"),
        ),
        "SELECT employee_id, comp_id, effective_date, row_number() OVER (PARTITION BY employee_id "
        "ORDER BY effective_date DESC, comp_id DESC) AS row_number FROM compensation",
    ),
    "r20_ranks": (
        lambda b: ranking.small_ranks(
            ranking.small_ranks(
                ranking.global_ntile(
                    b.employees.select("employee_id", "location", "age"), 4, F.desc("age"), "employee_id"
                ),
                "age",
                descending=True,
            ),
            "age",
            ["location"],
            descending=True,
            dense=True,
            name="dense_rank",
        ),
        "SELECT employee_id, location, CAST(age AS BIGINT) AS age, CAST(ntile(4) OVER (ORDER BY age DESC, employee_id) "
        "AS BIGINT) AS ntile, rank() OVER (ORDER BY age DESC) AS rank, dense_rank() OVER (PARTITION BY location "
        "ORDER BY age DESC) AS dense_rank FROM employees",
    ),
    "r21_percent_rank": (
        lambda b: ranking.value_ranks(
            newest(b.compensation, "employee_id", "effective_date", "comp_id").select("employee_id", "level", "bonus"),
            "bonus",
            ["level"],
            name="_r",
        ).select("employee_id", ((F.col("_r") - 1) / (F.col("_r_all") - 1)).alias("percent_rank")),
        f"SELECT employee_id, percent_rank() OVER (PARTITION BY level ORDER BY bonus) AS percent_rank FROM {_LATEST} l",
    ),
    "r22_lag": (
        lambda b: ranking.previous_value(
            b.performance.select("employee_id", "review_year", "rating_id", "rating"),
            "employee_id",
            ["review_year", "rating_id"],
            "rating",
            "previous_rating",
        ),
        f"SELECT employee_id, review_year, rating_id, {big('rating')} AS rating, {big('lag(rating) OVER (PARTITION BY employee_id ORDER BY review_year, rating_id)')} "
        "AS previous_rating FROM performance",
    ),
    "r23_rolling_rows": (
        lambda b: _months(b).withColumn("rolling", F.sum("n").over(Window.orderBy("month").rowsBetween(-11, 0))),
        f"SELECT month, n, {big('sum(n) OVER (ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)')} AS rolling "
        "FROM (SELECT strftime(effective_date, '%Y-%m') AS month, count(*) AS n FROM compensation GROUP BY 1) m",
    ),
    "r24_running_rows": (
        lambda b: _months(b).withColumn(
            "running", F.sum("n").over(Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0))
        ),
        f"SELECT month, n, {big('sum(n) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING)')} AS running "
        "FROM (SELECT strftime(effective_date, '%Y-%m') AS month, count(*) AS n FROM compensation GROUP BY 1) m",
    ),
    "r25_group_mean_beside_rows": (
        lambda b: relational.with_group_mean(
            b.performance.select("rating_id", "employee_id", "rating"), "employee_id", "rating", "mean_rating"
        ),
        f"SELECT rating_id, employee_id, {big('rating')} AS rating, CAST(sum(rating) OVER w AS DOUBLE) / count(*) OVER w "
        "AS mean_rating FROM performance WINDOW w AS (PARTITION BY employee_id)",
    ),
    "r26_rank_of_aggregate": (
        lambda b: ranking.value_ranks(
            b.learning.groupBy("employee_id").agg(F.sum("hours_completed").alias("hours")), "hours", descending=True
        ).drop("rank_all"),
        "SELECT employee_id, sum(hours_completed) AS hours, rank() OVER (ORDER BY sum(hours_completed) DESC) AS rank "
        "FROM learning GROUP BY employee_id",
    ),
    "r27_average_rank": (
        lambda b: ranking.average_ranks(b.employees.select("employee_id", "age"), "age"),
        "SELECT employee_id, CAST(age AS BIGINT) AS age, rank() OVER (ORDER BY age) "
        "+ (count(*) OVER (PARTITION BY age) - 1) / 2.0::DOUBLE AS rank FROM employees",
    ),
    "r28_sort": (
        lambda b: b.employees.select("employee_id", "department", "age").orderBy(
            "department", F.desc("age"), "employee_id"
        ),
        "SELECT employee_id, department, CAST(age AS BIGINT) AS age FROM employees ORDER BY department, age DESC, employee_id",
    ),
    "r29_top_k": (
        lambda b: ranking.top(b.compensation.select("comp_id", "salary"), 25, F.desc("salary"), "comp_id"),
        f"SELECT comp_id, {dbl('salary')} AS salary FROM compensation ORDER BY compensation.salary DESC, comp_id LIMIT 25",
    ),
    "r30_duplicate_rows": (
        lambda b: quality.duplicate_rows(b.learning).select(F.col("n").alias("repeated"), "rows"),
        "SELECT CAST(sum(c) - count(*) AS BIGINT) AS repeated, CAST(sum(c) AS BIGINT) AS rows FROM (SELECT count(*) AS c "
        "FROM learning GROUP BY employee_id, course_name, skill_category, hours_completed, completion_status, "
        "completion_date) g",
    ),
    "r31_named_subqueries": (
        lambda b: b.spark.sql(
            "WITH per_person AS (SELECT employee_id, count(*) AS n FROM {reviews} GROUP BY employee_id), "
            "sizes AS (SELECT n, count(*) AS people FROM per_person GROUP BY n) SELECT n, people FROM sizes",
            reviews=b.performance,
        ),
        "SELECT n, count(*) AS people FROM (SELECT employee_id, count(*) AS n FROM performance GROUP BY employee_id) p "
        "GROUP BY n",
    ),
    "r32_one_hot": (
        lambda b: features.one_hot(
            b.employees.select("employee_id", "level"), features.categories(b.employees, ["level"])
        ),
        "SELECT employee_id, "
        + ", ".join(f for f in _FLAGS.split(", ") if '"level_' in f)
        + " FROM employees b",
    ),
    "r33_right_closed_buckets": (
        lambda b: b.employees.select(
            "employee_id",
            buckets.right_closed(F.col("age"), 21, ((30, "to 30"), (45, "to 45"), (60, "to 60"))).alias("age_band"),
        ),
        "SELECT employee_id, CASE WHEN age <= 21 THEN NULL WHEN age <= 30 THEN 'to 30' WHEN age <= 45 THEN 'to 45' "
        "WHEN age <= 60 THEN 'to 60' END AS age_band FROM employees",
    ),
    # --- scalar functions ---
    "f1_year_month": (
        lambda b: b.compensation.select(
            "comp_id", F.year("effective_date").alias("year"), F.month("effective_date").alias("month")
        ),
        "SELECT comp_id, year(effective_date) AS year, month(effective_date) AS month FROM compensation",
    ),
    "f2_month_start": (
        lambda b: b.exits.select("employee_id", F.trunc("exit_date", "month").alias("month_start")),
        "SELECT employee_id, CAST(date_trunc('month', exit_date) AS DATE) AS month_start FROM exits",
    ),
    "f3_whole_years_and_months": (
        lambda b: b.employees.select(
            "employee_id",
            dates.full_years(dates.day(b.as_of), F.col("joining_date")).alias("full_years"),
            dates.full_months(dates.day(b.as_of), F.col("joining_date")).alias("full_months"),
        ),
        f"SELECT employee_id, {big(years(AS_OF, 'joining_date'))} AS full_years, CAST(12 * {years(AS_OF, 'joining_date')} "
        f"+ extract(MONTH FROM age({AS_OF}::TIMESTAMP, joining_date::TIMESTAMP)) AS BIGINT) AS full_months FROM employees",
    ),
    "f4_date_labels": (
        lambda b: b.exits.select(
            "employee_id",
            dates.month_label(F.col("exit_date")).alias("month"),
            F.date_format("exit_date", "MMM yyyy").alias("month_name"),
        ),
        "SELECT employee_id, strftime(exit_date, '%Y-%m') AS month, strftime(exit_date, '%b %Y') AS month_name FROM exits",
    ),
    "f5_date_arithmetic": (
        lambda b: b.exits.select(
            "employee_id",
            F.datediff(dates.day(b.as_of), "exit_date").alias("days_since"),
            (F.col("exit_date") >= dates.years_before(b.as_of, 2)).alias("within_two_years"),
        ),
        f"SELECT employee_id, {AS_OF} - exit_date AS days_since, exit_date >= {AS_OF} - INTERVAL 2 YEAR "
        "AS within_two_years FROM exits",
    ),
    "f6_tenure_months": (
        lambda b: b.employees.select(
            "employee_id", dates.tenure_months(dates.day(b.as_of), F.col("joining_date")).alias("tenure_months")
        ),
        f"SELECT employee_id, {tenure(AS_OF, 'joining_date')} AS tenure_months FROM employees",
    ),
    "f7_quarter_label": (
        lambda b: b.employees.select("employee_id", dates.quarter_label(F.col("joining_date")).alias("quarter")),
        "SELECT employee_id, year(joining_date) || 'Q' || quarter(joining_date) AS quarter FROM employees",
    ),
    "f8_case_and_null_functions": (
        lambda b: b.compensation.select(
            "comp_id",
            F.round("salary", 0).alias("whole_salary"),
            F.nullif("stock", F.lit(0)).alias("stock_or_null"),
            F.coalesce(F.nullif("stock", F.lit(0)), F.lit(-1)).alias("stock_or_less"),
            F.when(F.col("level") == "L1", "entry").when(F.col("level").isin("L4", "L5"), "senior").otherwise(
                "middle"
            ).alias("grade"),
        ),
        f"SELECT comp_id, {dbl('round(salary, 0)')} AS whole_salary, {dbl('nullif(stock, 0)')} AS stock_or_null, "
        f"{dbl('coalesce(nullif(stock, 0), -1)')} AS stock_or_less, CASE WHEN level = 'L1' THEN 'entry' "
        "WHEN level IN ('L4', 'L5') THEN 'senior' ELSE 'middle' END AS grade FROM compensation",
    ),
    "f9_text_tests": (
        lambda b: b.exits.select(
            "employee_id",
            (F.trim("exit_reason") == "").alias("is_blank"),
            F.col("exit_reason").startswith("Career").alias("is_career"),
        ),
        "SELECT employee_id, trim(exit_reason) = '' AS is_blank, starts_with(exit_reason, 'Career') AS is_career "
        "FROM exits",
    ),
}


def _months(b: Bound):
    return b.compensation.groupBy(dates.month_label(F.col("effective_date")).alias("month")).agg(
        F.count("*").alias("n")
    )
