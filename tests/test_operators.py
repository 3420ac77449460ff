"""Operators on hand-made tables: managers, salary, dashboard, quality, audits."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall.operators import attrition, audit, dashboard, managers, projects, quality, retention, salary
from rollcall.schema import bands_frame

D = dt.date
AS_OF = D(2024, 1, 1)
EMPLOYEE = (
    "employee_id bigint, gender string, age int, location string, department string, role string, level string, "
    "joining_date date, college_tier string, manager_id string, status string"
)


def person(i, manager="M1", status="Active", department="Ops", level="L1", joined=D(2020, 1, 1), **more):
    row = {
        "employee_id": i,
        "gender": "Female",
        "age": 30,
        "location": "X",
        "department": department,
        "role": "r",
        "level": level,
        "joining_date": joined,
        "college_tier": "Tier-1",
        "manager_id": manager,
        "status": status,
    }
    return tuple({**row, **more}.values())


@pytest.fixture(scope="module")
def tables(spark):
    emp = [
        person(1),
        person(2, status="Exited"),
        person(3, manager="M2"),
        person(4, manager="M2", level="L2"),
        person(5, manager=None, department="Lab", status="Exited"),
    ]
    perf = [(1, 1, 2022, 4, "Yes"), (2, 1, 2023, 5, "No"), (3, 2, 2022, 2, "No"), (4, 3, 2022, 3, "No"), (5, 4, 2022, 4, "Yes")]
    comp = [
        (1, 1, D(2022, 1, 1), "L1", 100, 1, 0),
        (2, 1, D(2023, 1, 1), "L1", 300, 1, 0),
        (3, 2, D(2022, 1, 1), "L1", 200, 1, 0),
        (4, 3, D(2022, 1, 1), "L1", 400, 1, 0),
        (5, 4, D(2022, 1, 1), "L9", 500, 1, 0),
    ]
    learn = [(1, "c", "s", 10.0, "Completed", D(2022, 1, 1)), (1, "d", "s", 5.0, "In Progress", None)]
    exits = [(2, D(2023, 6, 1), "Relocation", True), (5, D(2022, 6, 1), "Performance Issues", False)]
    return {
        "employees": spark.createDataFrame(emp, EMPLOYEE),
        "managers": spark.createDataFrame([("M1", "Ops", 9), ("M2", "Ops", 10), ("M3", "Lab", 3)], "manager_id string, department string, experience_years int"),
        "performance": spark.createDataFrame(perf, "rating_id bigint, employee_id bigint, review_year int, rating int, promotion string"),
        "compensation": spark.createDataFrame(
            [(*r[:4], *(Decimal(x) for x in r[4:])) for r in comp],
            "comp_id bigint, employee_id bigint, effective_date date, level string, salary decimal(12,2), bonus decimal(12,2), stock decimal(12,2)",
        ),
        "learning": spark.createDataFrame(learn, "employee_id bigint, course_name string, skill_category string, hours_completed double, completion_status string, completion_date date"),
        "exits": spark.createDataFrame(exits, "employee_id bigint, exit_date date, exit_reason string, voluntary boolean"),
    }


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_full_scorecard_drops_managers_without_courses_and_scorecard_keeps_them(tables):
    t = tables
    inner = managers.full_scorecard(t["employees"], t["managers"], t["performance"], t["compensation"], t["learning"])
    assert [r["manager_id"] for r in inner.collect()] == ["M1"]
    card = by_key(managers.scorecard(t["employees"], t["performance"], t["compensation"], t["learning"]), "manager_id")
    assert set(card) == {"M1", "M2"}
    assert card["M2"]["total_learning_hours"] is None


def test_history_mean_differs_from_latest_mean(tables):
    t = tables
    assert by_key(managers.team_salary(t["employees"], t["compensation"]), "manager_id")["M1"]["avg_team_salary"] == 200
    latest = by_key(managers.team_latest_salary(t["employees"], t["compensation"]), "manager_id")
    assert latest["M1"]["avg_team_salary"] == 250


def test_flags_follow_the_margin(tables):
    got = by_key(managers.benchmark(tables["employees"]), "manager_id")
    assert got["M1"]["company_attrition_pct"] == 40.0
    assert got["M1"]["manager_flag"] == managers.FLAGS[0]  # 50 against 40
    assert got["M2"]["manager_flag"] == managers.FLAGS[2]


def test_margin_itself_is_average(spark):
    emp = [person(i, manager="A" if i < 20 else "B", status="Exited" if i % 20 < (5 if i < 20 else 3) else "Active") for i in range(40)]
    got = by_key(managers.benchmark(spark.createDataFrame(emp, EMPLOYEE)), "manager_id")
    assert got["A"]["variance_from_avg"] == 5.0 and got["A"]["manager_flag"] == managers.FLAGS[1]
    assert got["B"]["variance_from_avg"] == -5.0 and got["B"]["manager_flag"] == managers.FLAGS[1]


def test_composite_risk_spans_zero_to_hundred(tables):
    t = tables
    card = by_key(managers.scorecard(t["employees"], t["performance"], t["compensation"], t["learning"]), "manager_id")
    assert card["M1"]["composite_risk_score"] == pytest.approx(60 + 0, abs=40)
    assert all(0 <= r["composite_risk_score"] <= 100 for r in card.values())


def test_unknown_level_has_no_band_and_passes(tables, spark):
    got = by_key(salary.band_audit(tables["compensation"], tables["employees"], bands_frame(spark, {"L1": (150, 350)})), "salary")
    assert {k: v["band_status"] for k, v in got.items()} == {
        100: "BELOW BAND",
        300: "IN BAND",
        200: "IN BAND",
        400: "ABOVE BAND",
        500: "IN BAND",
    }
    assert got[500]["band_min"] is None


def test_percentile_of_a_single_member_is_zero(tables):
    got = by_key(salary.percentiles(tables["compensation"], tables["employees"]), "employee_id")
    assert got[4]["salary_percentile"] == 0.0
    assert [got[i]["salary_percentile"] for i in (2, 1, 3)] == [0.0, 50.0, 100.0]


def test_employee_360_fans_out_and_flat_does_not(tables):
    t = tables
    args = (t["employees"], t["compensation"], t["performance"], t["exits"], AS_OF)
    assert dashboard.employee_360_flat(*args).count() == 5
    rows = dashboard.employee_360(*args).collect()
    assert sorted(r["employee_id"] for r in rows) == [1, 1, 2, 3, 4, 5]
    assert {r["avg_performance_rating"] for r in rows if r["employee_id"] == 1} == {4.5}
    assert next(r for r in rows if r["employee_id"] == 2)["tenure_years"] == 3.42


def test_rolling_exits_with_and_without_gap_months(spark):
    days = [D(2023, 1, 5), D(2023, 1, 9), D(2023, 4, 1)]
    exits = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "employee_id bigint, exit_date date")
    plain = [tuple(r) for r in dashboard.rolling_exits(exits, AS_OF).collect()]
    assert plain == [("Jan 2023", 2, 2), ("Apr 2023", 1, 3)]
    filled = [tuple(r) for r in dashboard.rolling_exits(exits, AS_OF, fill_months=True).collect()]
    assert filled == [("Jan 2023", 2, 2), ("Feb 2023", 0, 2), ("Mar 2023", 0, 2), ("Apr 2023", 1, 3)]


def test_growth_is_null_after_a_zero_salary(spark):
    rows = [(i, 1, D(2020 + i, 1, 1), Decimal(s)) for i, s in enumerate((0, 100, 150))]
    comp = spark.createDataFrame(rows, "comp_id bigint, employee_id bigint, effective_date date, salary decimal(12,2)")
    assert [r["yoy_growth_pct"] for r in salary.yearly_growth(comp).collect()] == [None, 50.0]


def test_flight_risk_uses_the_rounded_mean(spark):
    emp = spark.createDataFrame([person(1)], EMPLOYEE)
    # 2.9975 rounds to 3.00, which is not below 3.
    perf = spark.createDataFrame([(i, 1, 2020, 3 if i else 2, "No") for i in range(400)], "rating_id bigint, employee_id bigint, review_year int, rating int, promotion string")
    assert retention.flight_risk(emp, perf, AS_OF).count() == 0


def test_open_assignments_count_the_day_itself(spark):
    rows = [("p", "c", AS_OF, True), ("p", "c", None, False), ("p", "c", AS_OF - dt.timedelta(1), True)]
    df = spark.createDataFrame(rows, "project_name string, client_name string, end_date date, billable boolean")
    row = projects.open_assignments(df, AS_OF).first()
    assert (row["active_assignments"], row["billable_count"]) == (2, 1)


def test_above_company_compares_rounded_rates(spark):
    emp = [person(i, department="A" if i < 3 else "B", status="Exited" if i in (0, 3) else "Active") for i in range(9)]
    got = attrition.above_company(spark.createDataFrame(emp, EMPLOYEE)).collect()
    assert [tuple(r) for r in got] == [("A", 33.33, 22.22, 11.11)]


# --- quality -----------------------------------------------------------------


def results(df):
    return {r["check"]: (r["passed"], r["violations"], r["detail"]) for r in df.collect()}


def test_nulls_violate_ranges_but_not_signs(spark):
    emp = spark.createDataFrame([person(1, age=None, gender=None), person(2, age=61)], EMPLOYEE)
    got = results(quality.run_row_checks(emp, "s", quality.employee_checks(AS_OF)))
    assert got["Age Range (21–60)"][:2] == (False, 2)
    assert got["Gender Values"][:2] == (False, 1)
    comp = spark.createDataFrame([(None, None, None)], "salary decimal(12,2), bonus decimal(12,2), effective_date date")
    assert all(v[0] for v in results(quality.run_row_checks(comp, "s", quality.compensation_checks(AS_OF))).values())
    empty = results(quality.null_check(emp))["No Null Values"]
    assert empty == (False, 2, "gender: 1, age: 1")


def test_duplicates_and_orphans(spark, tables):
    emp = spark.createDataFrame([person(1), person(1), person(2)], EMPLOYEE)
    assert results(quality.uniqueness_check(emp))["Employee ID Uniqueness"] == (False, 1, "Duplicate IDs found: 1")
    proj = spark.createDataFrame([(7, "p")] * 3 + [(8, "q")], "employee_id bigint, project_name string")
    assert results(quality.duplicate_row_check(proj))["No Duplicate Assignment Rows"][1] == 2
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "employee_id bigint")
    assert results(quality.reference_check(child, emp, "learning"))[quality.REFERENCE][1] == 2


def test_one_pass_table_checks_agree_with_single_checks(spark):
    emp = spark.createDataFrame([person(1), person(1), person(2)], EMPLOYEE)
    rows = [(1, 1, 2020, 9, "Yes"), (2, 1, 2030, None, "Maybe"), (3, 5, 2020, 3, "No"), (4, 5, 2031, 3, None), (5, 6, 2020, 1, "No")]
    perf = spark.createDataFrame(rows, "rating_id bigint, employee_id bigint, review_year int, rating int, promotion string")
    together = results(quality.table_checks(perf, emp, "performance", AS_OF))
    apart = results(quality.run_row_checks(perf, "s", quality.performance_checks(AS_OF)))
    apart |= results(quality.reference_check(perf, emp, "performance"))
    assert together == apart
    assert together[quality.REFERENCE][1] == 2 and together["Performance Rating (1–5)"][1] == 2


def test_checks_of_grouped_rows_count_copies(spark):
    emp = spark.createDataFrame([person(1)], EMPLOYEE)
    late, early = D(AS_OF.year + 1, 1, 1), D(2019, 1, 1)
    rows = [(1, "a", late, None, True)] * 3 + [(1, "a", early, late, True), (None, "b", late, early, None), (None, "b", late, early, None), (9, "c", None, None, False)]
    proj = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "assignment_id int, employee_id bigint, project_name string, start_date date, end_date date, billable boolean")
    grouped = quality.distinct_rows(quality.assignments(proj))
    assert grouped.count() == 4
    together = results(quality.table_checks(grouped, emp, "projects", AS_OF, "_n"))
    assert together == results(quality.table_checks(proj, emp, "projects", AS_OF))
    assert together["Project Start Date (No Future)"][1] == 5 and together[quality.REFERENCE][1] == 2


def test_empty_tables_pass(spark, tables):
    t = {k: df.limit(0) for k, df in tables.items()}
    t["projects"] = spark.createDataFrame([], "employee_id bigint, project_name string, client_name string, start_date date, end_date date, billable boolean")
    report = quality.validation_report(t, bands_frame(spark), AS_OF)
    assert report.count() == 30 and quality.all_passed(report)


def test_schema_check_lists_missing_columns(tables):
    row = quality.schema_check(tables["employees"].drop("age", "role")).first()
    assert (row["passed"], row["violations"]) == (False, 2) and "age" in row["detail"]


def test_exit_before_joining_counts_rows(spark, tables):
    exits = spark.createDataFrame([(1, D(2019, 1, 1)), (1, D(2019, 2, 1)), (2, D(2021, 1, 1)), (99, D(2000, 1, 1))], "employee_id bigint, exit_date date")
    assert results(quality.exit_order_check(exits, tables["employees"]))[quality.EXIT_ORDER][1] == 2


def test_text_flags(spark):
    df = spark.createDataFrame([("True",), ("no",), (None,), ("Yes",)], "billable string")
    bad = {r["billable"]: r["row_count"] for r in quality.offenders(df, "billable", quality.BILLABLE_WORDS).collect()}
    assert bad == {"no": 1, None: 1}


def test_frequencies_skip_nulls_and_sum_to_hundred(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    got = {r["value"]: (r["row_count"], r["share_pct"]) for r in audit.frequencies(df, "x").collect()}
    assert got == {"a": (2, 66.67), "b": (1, 33.33)}


def test_totals(spark):
    df = spark.createDataFrame([(True,), (False,), (True,)], "passed boolean")
    assert tuple(quality.totals(df).first()) == (3, 2, 1)
    assert df.select(F.count_if("passed")).first()[0] == 2
