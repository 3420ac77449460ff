"""Registered queries: the seventy report statements."""

from __future__ import annotations

from rollcall.operators import attrition, dashboard, headcount, learning, managers, projects, retention, salary
from rollcall.plans.bound import Bound
from rollcall.plans.oracle import (
    AS_OF,
    LATEST,
    big,
    dbl,
    half_up,
    mean_int,
    mean_money,
    rate,
    share,
    where,
    years,
)

EXITED = "status = 'Exited'"
ACTIVE = "status = 'Active'"


def _attrition_sql(key: str) -> str:
    return (
        f"SELECT {key}, count(*) AS total_employees, {where(EXITED)} AS exited, {rate(EXITED)} AS attrition_rate_pct "
        f"FROM employees GROUP BY {key}"
    )


TEAM = "FROM employees WHERE manager_id IS NOT NULL GROUP BY manager_id"
COMPANY = f"(SELECT {rate(EXITED)} FROM employees)"
CURRENT = f"(SELECT l.* EXCLUDE (level), e.department, e.level FROM ({LATEST}) l JOIN employees e USING (employee_id))"
RATINGS = f"(SELECT employee_id, {mean_int('rating')} AS avg_rating FROM performance GROUP BY employee_id)"
PLACE = half_up("(rank() OVER w - 1)", "greatest(count(*) OVER v - 1, 1)", 1, 100)
PERCENTILES = (
    f"(SELECT employee_id, department, level, {dbl('salary')} AS salary, {PLACE} AS salary_percentile "
    f"FROM {CURRENT} c WINDOW w AS (PARTITION BY level ORDER BY salary), v AS (PARTITION BY level))"
)
TENURE = big(years(AS_OF, "joining_date"))
HOURS = "CAST(sum(hours_completed) AS HUGEINT)"
HOURS_MEAN = half_up(HOURS, "count(hours_completed)")

QUERIES = {
    # --- headcount ---
    "q1_1_total_headcount": (
        lambda b: headcount.total(b.employees),
        "SELECT count(*) AS total_employees FROM employees",
    ),
    "q1_2_status_split": (
        lambda b: headcount.split(b.employees, "status"),
        share("status", "employees", "employees"),
    ),
    "q1_3_headcount_by_department": (
        lambda b: headcount.by(b.employees, "department"),
        "SELECT department, count(*) AS employees FROM employees GROUP BY department",
    ),
    "q1_4_gender_split": (
        lambda b: headcount.split(b.employees, "gender"),
        share("gender", "employees", "employees"),
    ),
    "q1_5_college_tier_split": (
        lambda b: headcount.split(b.employees, "college_tier").orderBy("college_tier"),
        share("college_tier", "employees", "employees"),
    ),
    "q1_6_headcount_by_level": (
        lambda b: headcount.by(b.employees, "level").orderBy("level"),
        "SELECT level, count(*) AS employees FROM employees GROUP BY level",
    ),
    "q1_7_hires_per_year": (
        lambda b: headcount.hires_per_year(b.employees),
        "SELECT year(joining_date) AS hire_year, count(*) AS new_hires FROM employees GROUP BY ALL",
    ),
    "q1_8_active_by_location": (
        lambda b: headcount.active_by_location(b.employees),
        f"SELECT location, count(*) AS active_employees FROM employees WHERE {ACTIVE} GROUP BY location",
    ),
    # --- attrition ---
    "q2_1_overall_attrition": (
        lambda b: attrition.overall(b.employees),
        f"SELECT {rate(EXITED)} AS overall_attrition_pct FROM employees",
    ),
    "q2_2_attrition_by_department": (
        lambda b: attrition.by(b.employees, "department"),
        _attrition_sql("department"),
    ),
    "q2_3_attrition_by_location": (lambda b: attrition.by(b.employees, "location"), _attrition_sql("location")),
    "q2_4_attrition_by_level": (
        lambda b: attrition.by(b.employees, "level").orderBy("level"),
        _attrition_sql("level"),
    ),
    "q2_5_attrition_by_gender": (lambda b: attrition.by(b.employees, "gender"), _attrition_sql("gender")),
    "q2_6_exits_per_year": (
        lambda b: attrition.exits_per_year(b.exits),
        "SELECT year(exit_date) AS exit_year, count(*) AS exits_in_year FROM exits GROUP BY ALL",
    ),
    "q2_7_voluntary_split": (
        lambda b: attrition.voluntary_split(b.exits),
        "SELECT CASE WHEN voluntary THEN 'Voluntary' ELSE 'Involuntary' END AS attrition_type, exits, percentage "
        f"FROM ({share('voluntary', 'exits', 'exits')}) g",
    ),
    "q2_8_exit_reasons": (
        lambda b: attrition.reasons(b.exits),
        share("exit_reason", "total_exits", "exits"),
    ),
    "q2_9_departments_above_company": (
        lambda b: attrition.above_company(b.employees),
        "SELECT *, round(attrition_pct - avg_attrition, 2) AS variance_from_avg "
        f"FROM (SELECT department, {rate(EXITED)} AS attrition_pct, {COMPANY} AS avg_attrition "
        "FROM employees GROUP BY department) d WHERE attrition_pct > avg_attrition",
    ),
    # --- manager effect ---
    "k1_team_size": (
        lambda b: managers.team_size(b.employees),
        f"SELECT manager_id, count(*) AS team_size {TEAM}",
    ),
    "k2_team_attrition": (
        lambda b: managers.team_attrition(b.employees),
        f"SELECT manager_id, count(*) AS team_size, {where(EXITED)} AS exits, {rate(EXITED)} AS attrition_rate_pct "
        f"{TEAM}",
    ),
    "k3_team_rating": (
        lambda b: managers.team_rating(b.employees, b.performance),
        f"SELECT manager_id, {mean_int('rating')} AS avg_team_rating FROM performance JOIN employees "
        "USING (employee_id) WHERE manager_id IS NOT NULL GROUP BY manager_id",
    ),
    "k4_team_salary": (
        lambda b: managers.team_salary(b.employees, b.compensation),
        f"SELECT manager_id, {mean_money('salary')} AS avg_team_salary FROM compensation JOIN employees "
        "USING (employee_id) WHERE manager_id IS NOT NULL GROUP BY manager_id",
    ),
    "k5_team_learning": (
        lambda b: managers.team_learning(b.employees, b.learning),
        f"SELECT manager_id, sum(hours_completed) AS total_learning_hours, {HOURS_MEAN} AS avg_hours_per_course "
        "FROM learning JOIN employees USING (employee_id) WHERE manager_id IS NOT NULL GROUP BY manager_id",
    ),
    "k6_team_promotions": (
        lambda b: managers.team_promotions(b.employees, b.performance),
        f"""SELECT manager_id, count(*) AS total_appraisals, {where("promotion = 'Yes'")} AS promotions_given, """
        f"""{rate("promotion = 'Yes'")} AS promotion_rate_pct FROM performance JOIN employees USING (employee_id) """
        "WHERE manager_id IS NOT NULL GROUP BY manager_id",
    ),
    "k7_full_scorecard": (
        lambda b: managers.full_scorecard(b.employees, b.managers, b.performance, b.compensation, b.learning),
        f"""SELECT manager_id, m.department, {big("experience_years")} AS experience_years, team_size, exits,
 attrition_rate_pct, avg_team_rating, avg_team_salary, total_learning_hours, promotion_rate_pct
FROM (SELECT manager_id, count(*) AS team_size, {where(EXITED)} AS exits, {rate(EXITED)} AS attrition_rate_pct {TEAM}) a
JOIN managers m USING (manager_id)
JOIN (SELECT manager_id, {mean_int("rating")} AS avg_team_rating, {rate("promotion = 'Yes'")} AS promotion_rate_pct
 FROM performance JOIN employees USING (employee_id) GROUP BY manager_id) r USING (manager_id)
JOIN (SELECT manager_id, {mean_money("salary")} AS avg_team_salary
 FROM compensation JOIN employees USING (employee_id) GROUP BY manager_id) s USING (manager_id)
JOIN (SELECT manager_id, sum(hours_completed) AS total_learning_hours
 FROM learning JOIN employees USING (employee_id) GROUP BY manager_id) h USING (manager_id)""",
    ),
    "k8_risk_ranks": (
        lambda b: managers.risk_ranks(b.employees, b.managers),
        f"""SELECT manager_id, department, team_size, exits, attrition_rate_pct,
 {big("rank() OVER (ORDER BY attrition_rate_pct DESC)")} AS risk_rank,
 {big("dense_rank() OVER (PARTITION BY department ORDER BY attrition_rate_pct DESC)")} AS risk_rank_within_dept,
 {big("ntile(4) OVER (ORDER BY attrition_rate_pct DESC, manager_id)")} AS risk_quartile
FROM (SELECT manager_id, count(*) AS team_size, {where(EXITED)} AS exits, {rate(EXITED)} AS attrition_rate_pct {TEAM}) a
JOIN (SELECT manager_id, department FROM managers) m USING (manager_id)""",
    ),
    "k9_benchmark": (
        lambda b: managers.benchmark(b.employees),
        f"""SELECT *, CASE WHEN variance_from_avg > 5 THEN '{managers.FLAGS[0]}'
 WHEN variance_from_avg < -5 THEN '{managers.FLAGS[2]}' ELSE '{managers.FLAGS[1]}' END AS manager_flag
FROM (SELECT manager_id, attrition_rate_pct, c AS company_attrition_pct,
  round(attrition_rate_pct - c, 2) AS variance_from_avg
 FROM (SELECT manager_id, {rate(EXITED)} AS attrition_rate_pct, {COMPANY} AS c {TEAM}) a) v""",
    ),
    # --- salary ---
    "q4_1_salary_by_level": (
        lambda b: salary.by_level(b.compensation),
        f"SELECT level, {mean_money('salary')} AS avg_salary, {dbl('round(min(salary), 0)')} AS min_salary, "
        f"{dbl('round(max(salary), 0)')} AS max_salary, round(stddev_samp({dbl('salary')}), 0) AS salary_stddev "
        "FROM compensation GROUP BY level",
    ),
    "q4_2_salary_by_department": (
        lambda b: salary.by_department(b.compensation, b.employees),
        f"SELECT department, {mean_money('salary')} AS avg_salary FROM compensation "
        "JOIN employees USING (employee_id) GROUP BY department",
    ),
    "q4_3_pay_gap": (
        lambda b: salary.pay_gap(b.compensation, b.employees),
        f"SELECT e.level, gender, {mean_money('salary')} AS avg_salary FROM compensation c "
        "JOIN employees e USING (employee_id) GROUP BY ALL",
    ),
    "q4_4_latest_compensation": (
        lambda b: salary.latest_with_staff(b.compensation, b.employees),
        f"SELECT employee_id, department, level, {dbl('salary')} AS salary, {dbl('bonus')} AS bonus, "
        f"{dbl('stock')} AS stock, effective_date FROM {CURRENT} c",
    ),
    "q4_5_salary_percentile": (
        lambda b: salary.percentiles(b.compensation, b.employees),
        f"SELECT * FROM {PERCENTILES} p",
    ),
    "q4_6_salary_by_year": (
        lambda b: salary.by_year(b.compensation),
        f"SELECT year(effective_date) AS comp_year, {mean_money('salary')} AS avg_salary, "
        f"{mean_money('bonus')} AS avg_bonus FROM compensation GROUP BY ALL",
    ),
    "q4_7_cost_by_department": (
        lambda b: salary.cost_by_department(b.compensation, b.employees),
        f"SELECT department, {dbl('round(sum(salary + bonus + stock), 0)')} AS total_comp_cost, "
        f"count(DISTINCT employee_id) AS headcount, {mean_money('(salary + bonus + stock)')} "
        f"AS avg_total_comp_per_employee FROM {CURRENT} c GROUP BY department",
    ),
    "q4_8_band_audit": (
        lambda b: salary.band_audit(b.compensation, b.employees, b.bands),
        f"""SELECT employee_id, department, c.level, {dbl("salary")} AS salary, {dbl("band_min")} AS band_min,
 {dbl("band_max")} AS band_max, CASE WHEN salary < band_min THEN 'BELOW BAND' WHEN salary > band_max
 THEN 'ABOVE BAND' ELSE 'IN BAND' END AS band_status
FROM compensation c JOIN employees e USING (employee_id) LEFT JOIN bands b ON b.level = c.level""",
    ),
    # --- learning ---
    "q5_1_hours_by_department": (
        lambda b: learning.hours_by_department(b.learning, b.employees),
        f"SELECT department, sum(hours_completed) AS total_hours, {HOURS_MEAN} AS avg_hours_per_course, "
        "count(*) AS total_enrollments FROM learning JOIN employees USING (employee_id) GROUP BY department",
    ),
    "q5_2_skill_distribution": (
        lambda b: learning.skills(b.learning),
        share(
            "skill_category",
            "enrollments",
            "learning",
            "enrollment_share_pct",
            ", sum(hours_completed) AS total_hours",
        ),
    ),
    "q5_3_completion_by_skill": (
        lambda b: learning.completion_by_skill(b.learning),
        f"""SELECT skill_category, count(*) AS total_enrollments, {where("completion_status = 'Completed'")} """
        f"""AS completed, {rate("completion_status = 'Completed'")} AS completion_rate_pct """
        "FROM learning GROUP BY skill_category",
    ),
    "q5_4_top_learners": (
        lambda b: learning.top_learners(b.learning, b.employees),
        f"""SELECT employee_id, department, level, total_hours, courses_taken,
 {big("rank() OVER (ORDER BY total_hours DESC)")} AS learner_rank
FROM (SELECT employee_id, sum(hours_completed) AS total_hours, count(*) AS courses_taken
 FROM learning GROUP BY employee_id) h JOIN employees USING (employee_id)
ORDER BY learner_rank, employee_id LIMIT 20""",
    ),
    "q5_5_hours_by_level": (
        lambda b: learning.hours_by_level(b.learning, b.employees),
        f"SELECT level, {half_up('CAST(sum(h) AS HUGEINT)', 'count(h)')} AS avg_hours_per_employee FROM "
        "(SELECT employee_id, sum(hours_completed) AS h FROM learning GROUP BY employee_id) x "
        "JOIN employees USING (employee_id) GROUP BY level",
    ),
    "q5_6_learning_band_vs_rating": (
        lambda b: learning.band_vs_rating(b.learning, b.performance),
        f"""SELECT CASE WHEN h < 20 THEN 'Low  (<20 hrs)' WHEN h < 50 THEN 'Mid  (20-49 hrs)'
 WHEN h < 100 THEN 'High (50-99 hrs)' ELSE 'Top  (100+ hrs)' END AS learning_band, count(*) AS employees,
 {half_up("CAST(round(sum(avg_rating * 100)) AS HUGEINT)", "(100 * count(*))", 3)} AS avg_performance_rating
FROM (SELECT employee_id, sum(hours_completed) AS h FROM learning GROUP BY employee_id) x
JOIN {RATINGS} r USING (employee_id) GROUP BY learning_band""",
    ),
    "q5_7_completions_per_year": (
        lambda b: learning.completions_per_year(b.learning),
        "SELECT year(completion_date) AS completion_year, count(*) AS courses_completed, "
        "sum(hours_completed) AS hours_completed FROM learning "
        "WHERE completion_status = 'Completed' AND completion_date IS NOT NULL GROUP BY completion_year",
    ),
    # --- retention ---
    "q6_1_mean_tenure": (
        lambda b: retention.mean_tenure(b.employees, b.as_of),
        f"SELECT {mean_int(TENURE)} AS avg_tenure_years FROM employees WHERE {ACTIVE}",
    ),
    "q6_2_mean_tenure_at_exit": (
        lambda b: retention.mean_tenure_at_exit(b.exits, b.employees),
        f"SELECT {mean_int(years('exit_date', 'joining_date'))} AS avg_tenure_before_exit_years "
        "FROM exits JOIN employees USING (employee_id)",
    ),
    "q6_3_tenure_buckets": (
        lambda b: retention.tenure_buckets(b.employees, b.as_of),
        f"""SELECT CASE WHEN y < 1 THEN '< 1 year' WHEN y < 3 THEN '1–3 years' WHEN y < 5 THEN '3–5 years'
 WHEN y < 10 THEN '5–10 years' ELSE '10+ years' END AS tenure_bucket, count(*) AS employees
FROM (SELECT {TENURE} AS y FROM employees WHERE {ACTIVE}) e GROUP BY tenure_bucket""",
    ),
    "q6_4_flight_risk": (
        lambda b: retention.flight_risk(b.employees, b.performance, b.as_of),
        f"SELECT employee_id, department, level, location, {dbl(TENURE)} AS tenure_years, avg_rating "
        f"FROM employees JOIN {RATINGS} r USING (employee_id) WHERE {ACTIVE} AND avg_rating < 3 AND {TENURE} >= 3",
    ),
    "q6_5_underpaid_performers": (
        lambda b: retention.underpaid_performers(b.employees, b.compensation, b.performance),
        "SELECT employee_id, p.department, p.level, avg_rating, salary, salary_percentile, "
        f"'HIGH RISK' AS retention_flag FROM {PERCENTILES} p JOIN employees e USING (employee_id) "
        f"JOIN {RATINGS} r USING (employee_id) WHERE {ACTIVE} AND avg_rating >= 4 AND salary_percentile < 40",
    ),
    "q6_6_retention_by_department": (
        lambda b: retention.by_department(b.employees),
        f"SELECT department, count(*) AS ever_hired, {where(ACTIVE)} AS still_active, {rate(ACTIVE)} "
        "AS retention_rate_pct FROM employees GROUP BY department",
    ),
    "q6_7_exits_by_month": (
        lambda b: retention.exits_by_month(b.exits, b.as_of),
        f"SELECT strftime(exit_date, '%Y-%m') AS exit_month, count(*) AS exits FROM exits "
        f"WHERE exit_date >= {AS_OF} - INTERVAL 2 YEAR GROUP BY exit_month",
    ),
    # --- projects ---
    "q7_1_project_staffing": (
        lambda b: projects.staffing(b.projects),
        "SELECT project_name, count(*) AS employees_assigned FROM projects GROUP BY project_name",
    ),
    "q7_2_billable_split": (
        lambda b: projects.billing_split(b.projects),
        "SELECT CASE WHEN billable THEN 'Billable' ELSE 'Non-Billable' END AS billing_type, assignments, percentage "
        f"FROM ({share('billable', 'assignments', 'projects')}) g",
    ),
    "q7_3_top_clients": (
        lambda b: projects.top_clients(b.projects),
        "SELECT client_name, count(*) AS assignments, count(DISTINCT project_name) AS distinct_projects, "
        "count(DISTINCT employee_id) AS unique_employees FROM projects GROUP BY client_name "
        "ORDER BY assignments DESC, client_name LIMIT 15",
    ),
    "q7_4_project_duration": (
        lambda b: projects.durations(b.projects),
        f"SELECT project_name, count(*) AS team_size, {mean_int('(end_date - start_date)', 0)} AS avg_duration_days, "
        "min(start_date) AS earliest_start, max(end_date) AS latest_end FROM projects "
        "WHERE end_date IS NOT NULL GROUP BY project_name",
    ),
    "q7_5_open_assignments": (
        lambda b: projects.open_assignments(b.projects, b.as_of),
        f"SELECT project_name, client_name, count(*) AS active_assignments, {where('billable')} AS billable_count "
        f"FROM projects WHERE end_date >= {AS_OF} OR end_date IS NULL GROUP BY project_name, client_name",
    ),
    "q7_6_project_attrition": (
        lambda b: projects.attrition(b.projects, b.employees),
        f"SELECT project_name, client_name, count(*) AS total_assignments, {where(EXITED)} AS exited_employees, "
        f"{rate(EXITED)} AS attrition_rate_pct FROM projects JOIN employees USING (employee_id) "
        "GROUP BY project_name, client_name ORDER BY attrition_rate_pct DESC, project_name, client_name LIMIT 20",
    ),
    "q7_7_project_load": (
        lambda b: projects.workload(b.projects, b.employees),
        f"""SELECT employee_id, department, level, n AS projects_worked_on,
 {big("rank() OVER (ORDER BY n DESC)")} AS workload_rank
FROM (SELECT employee_id, count(DISTINCT project_name) AS n FROM projects GROUP BY employee_id) p
JOIN employees USING (employee_id) ORDER BY workload_rank, employee_id LIMIT 20""",
    ),
    "q7_8_projects_by_department": (
        lambda b: projects.by_department(b.projects, b.employees),
        f"SELECT department, count(DISTINCT project_name) AS distinct_projects, count(*) AS total_assignments, "
        f"{where('billable')} AS billable_assignments FROM projects JOIN employees USING (employee_id) "
        "GROUP BY department",
    ),
    # --- views and dashboard ---
    "v1_latest_compensation_view": (
        lambda b: dashboard.latest_compensation(b.compensation),
        f"SELECT employee_id, level, {dbl('salary')} AS salary, {dbl('bonus')} AS bonus, {dbl('stock')} AS stock, "
        f"effective_date FROM ({LATEST}) l",
    ),
}

_PAID = f"({LATEST})"
_AGE = f"age(CAST(coalesce(exit_date, {AS_OF}) AS TIMESTAMP), CAST(joining_date AS TIMESTAMP))"
_360 = f"""SELECT e.employee_id, gender, {big("age")} AS age, location, department, role, e.level, joining_date,
 college_tier, manager_id, status, {dbl("salary")} AS salary, {dbl("bonus")} AS bonus, {dbl("stock")} AS stock,
 avg_performance_rating,
 {half_up(f"(12 * extract(YEAR FROM {_AGE}) + extract(MONTH FROM {_AGE}))", "12")} AS tenure_years,
 exit_date, exit_reason, voluntary AS voluntary_exit"""
_360_FROM = f"""FROM employees e LEFT JOIN {_PAID} lc ON lc.employee_id = e.employee_id
LEFT JOIN (SELECT employee_id, {mean_int("rating")} AS avg_performance_rating, count(*) AS reviews
 FROM performance GROUP BY employee_id) r ON r.employee_id = e.employee_id
LEFT JOIN exits x ON x.employee_id = e.employee_id"""
_KPIS = (
    f"SELECT department, count(*) AS total_employees, {where(ACTIVE)} AS active, {where(EXITED)} AS exited, "
    f"{rate(EXITED)} AS attrition_rate_pct FROM employees GROUP BY department"
)


def _360_tables(b: Bound):
    return b.employees, b.compensation, b.performance, b.exits, b.as_of


QUERIES |= {
    "v2_employee_360": (
        lambda b: dashboard.employee_360(*_360_tables(b)),
        f"{_360} {_360_FROM} LEFT JOIN performance p ON p.employee_id = e.employee_id",
    ),
    "v2_employee_360_flat": (
        lambda b: dashboard.employee_360_flat(*_360_tables(b)),
        f"{_360}, coalesce(reviews, 0) AS reviews {_360_FROM}",
    ),
    "v3_department_kpis": (lambda b: dashboard.department_kpis(b.employees), _KPIS),
    "d1_company_snapshot": (
        lambda b: dashboard.company_snapshot(b.employees, b.as_of),
        f"SELECT count(*) AS total_employees, {where(ACTIVE)} AS active_employees, {where(EXITED)} AS total_exits, "
        f"{rate(EXITED)} AS attrition_pct, {mean_int(f'CASE WHEN {ACTIVE} THEN {TENURE} END')} "
        "AS avg_tenure_active_yrs FROM employees",
    ),
    "d2_department_grid": (lambda b: dashboard.department_grid(b.employees), f"{_KPIS} ORDER BY 5 DESC, 1"),
    "d3_rolling_exits": (
        lambda b: dashboard.rolling_exits(b.exits, b.as_of),
        f"""SELECT strftime(m, '%b %Y') AS month, exits,
 {big("sum(exits) OVER (ORDER BY m ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)")} AS rolling_12m_exits
FROM (SELECT date_trunc('month', exit_date) AS m, count(*) AS exits FROM exits
 WHERE exit_date >= {AS_OF} - INTERVAL 2 YEAR GROUP BY m) x""",
    ),
    "d4_rating_histogram": (
        lambda b: dashboard.rating_histogram(b.performance),
        f'SELECT {big("rating")} AS rating, n AS "count", percentage '
        f"FROM ({share('rating', 'n', 'performance')}) g",
    ),
    "d5_salary_vs_rating": (
        lambda b: dashboard.salary_vs_rating(b.employees, b.compensation, b.performance),
        f"""SELECT department, avg_salary, avg_rating
FROM (SELECT department, {mean_money("salary")} AS avg_salary FROM {CURRENT} c GROUP BY department) s
JOIN (SELECT department, {mean_int("rating")} AS avg_rating FROM performance JOIN employees USING (employee_id)
 GROUP BY department) r USING (department)""",
    ),
    "d6_promotion_rate": (
        lambda b: dashboard.promotion_rate(b.performance),
        f"""SELECT {rate("promotion = 'Yes'")} AS overall_promotion_rate_pct FROM performance""",
    ),
    "d7_promotion_candidates": (
        lambda b: dashboard.promotion_candidates(b.employees, b.performance),
        f"SELECT employee_id, department, level, location, {mean_int('rating')} AS avg_rating, "
        f"count(review_year) AS years_reviewed FROM performance JOIN employees USING (employee_id) WHERE {ACTIVE} "
        "GROUP BY employee_id, department, level, location HAVING sum(rating) >= 4 * count(rating) "
        "ORDER BY avg_rating DESC, employee_id LIMIT 10",
    ),
    "d8_learning_vs_attrition": (
        lambda b: dashboard.learning_vs_attrition(b.employees, b.learning),
        f"SELECT department, avg_learning_hrs, attrition_rate_pct FROM ({_KPIS}) k JOIN (SELECT department, "
        f"{HOURS_MEAN} AS avg_learning_hrs FROM learning JOIN employees USING (employee_id) GROUP BY department) l "
        "USING (department)",
    ),
    "w1_yearly_salary_growth": (
        lambda b: salary.yearly_growth(b.compensation),
        f"""SELECT employee_id, comp_year, {dbl("salary")} AS salary, {dbl("p")} AS prev_year_salary,
 {half_up("CAST((salary - p) * 100 AS HUGEINT)", "CAST(p * 100 AS HUGEINT)", 2, 100)} AS yoy_growth_pct
FROM (SELECT employee_id, year(effective_date) AS comp_year, salary, lag(salary) OVER (PARTITION BY employee_id
 ORDER BY year(effective_date), effective_date, comp_id) AS p FROM compensation) x WHERE p IS NOT NULL""",
    ),
    "w2_cumulative_hires": (
        lambda b: dashboard.cumulative_hires(b.employees),
        f"""SELECT strftime(m, '%Y-%m') AS hire_month, new_hires,
 {big("sum(new_hires) OVER (ORDER BY m ROWS UNBOUNDED PRECEDING)")} AS cumulative_hires
FROM (SELECT date_trunc('month', joining_date) AS m, count(*) AS new_hires FROM employees GROUP BY m) x""",
    ),
    "w3_salary_quartiles": (
        lambda b: salary.quartiles(b.compensation, b.employees),
        f"SELECT employee_id, department, level, {dbl('salary')} AS salary, "
        f"{big('ntile(4) OVER (ORDER BY c.salary, employee_id)')} AS salary_quartile FROM {CURRENT} c",
    ),
}
