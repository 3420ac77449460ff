"""Registered queries: manager scorecard and survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators import managers, survival
from rollcall.plans.bound import Bound
from rollcall.plans.oracle import (
    AS_OF,
    LATEST,
    big,
    dbl,
    half_even,
    mean_int,
    mean_money,
    rate,
    tenure,
    where,
)
from rollcall.sources.scratch import written

EXITED = "status = 'Exited'"
TEAM = "FROM employees WHERE manager_id IS NOT NULL GROUP BY manager_id"
PROMOTED = "promotion = 'Yes'"
HIGH, AVERAGE, STAR = managers.MARKED_FLAGS
HOURS_MEAN = half_even("CAST(sum(hours_completed) AS HUGEINT)", "count(hours_completed)")
_MEMBERS = "JOIN employees e ON e.employee_id = h.employee_id WHERE manager_id IS NOT NULL GROUP BY manager_id"

ATTRITION = (
    f"SELECT manager_id, count(*) AS team_size, {where(EXITED)} AS exits, "
    f"{rate(EXITED, 2, half_even)} AS attrition_rate_pct {TEAM}"
)
RATING = (
    f"SELECT manager_id, {mean_int('rating', 2, half_even)} AS avg_team_rating FROM performance h {_MEMBERS}"
)
SALARY = (
    f"SELECT manager_id, {mean_money('salary', 0, half_even)} AS avg_team_salary FROM ({LATEST}) h {_MEMBERS}"
)
LEARNING = (
    f"SELECT manager_id, sum(hours_completed) AS total_learning_hours, {HOURS_MEAN} AS avg_hours_per_course "
    f"FROM learning h {_MEMBERS}"
)
PROMOTION = (
    f"SELECT manager_id, count(*) AS total_appraisals, {where(PROMOTED)} AS promotions, "
    f"{rate(PROMOTED, 2, half_even)} AS promotion_rate_pct FROM performance h {_MEMBERS}"
)
_UNIT = "({0} - min({0}) OVER ()) / (max({0}) OVER () - min({0}) OVER () + 1e-9)"
_COMPOSITE = (
    f"round(({_UNIT.format('attrition_rate_pct')} * 0.6 + (1.0 - {_UNIT.format('avg_team_rating')}) * 0.4) * 100, 1)"
)
CARD = f"""SELECT *, CASE WHEN variance_from_avg > 5 THEN '{HIGH}' WHEN variance_from_avg < -5 THEN '{STAR}'
 ELSE '{AVERAGE}' END AS manager_flag
FROM (SELECT manager_id, team_size, exits, attrition_rate_pct, avg_team_rating, avg_team_salary,
  total_learning_hours, promotion_rate_pct, {big("rank() OVER (ORDER BY attrition_rate_pct DESC)")} AS risk_rank,
  c AS company_avg_attrition_pct, round(attrition_rate_pct - c, 2) AS variance_from_avg,
  {_COMPOSITE} AS composite_risk_score
 FROM ({ATTRITION}) a LEFT JOIN ({RATING}) r USING (manager_id) LEFT JOIN ({SALARY}) s USING (manager_id)
 LEFT JOIN ({LEARNING}) l USING (manager_id) LEFT JOIN ({PROMOTION}) p USING (manager_id)
 CROSS JOIN (SELECT {rate(EXITED, 2, half_even)} AS c FROM employees) co) v"""

# --- survival ---
_T = tenure(f"coalesce(exit_date, {AS_OF})", "joining_date")
SPELLS = f"""(SELECT e.*, exit_date, coalesce(exit_date, {AS_OF}) AS end_date, {_T} AS tenure_months,
 CASE WHEN {EXITED} THEN 1 ELSE 0 END AS event, year(joining_date) || 'Q' || quarter(joining_date) AS joining_quarter,
 year(joining_date) AS joining_year
FROM employees e LEFT JOIN exits x ON x.employee_id = e.employee_id
WHERE coalesce(exit_date, {AS_OF}) - joining_date > 0)"""


def curve_sql(cohort: str, keep: str = "true") -> str:
    """Curve rows (cohort, t, at_risk, d, c, s, v) of each cohort."""
    return f"""(WITH k AS (SELECT CAST({cohort} AS VARCHAR) AS cohort, tenure_months AS t, sum(event) AS d,
  sum(1 - event) AS c FROM {SPELLS} sp WHERE {keep} GROUP BY 1, 2),
 r AS (SELECT *, sum(d + c) OVER (PARTITION BY cohort ORDER BY t DESC) AS n FROM k)
SELECT cohort, t, CAST(n AS BIGINT) AS at_risk, CAST(d AS BIGINT) AS d, CAST(c AS BIGINT) AS c,
 product(1 - CAST(d AS DOUBLE) / n) OVER (PARTITION BY cohort ORDER BY t) AS s,
 sum(CASE WHEN n > d THEN CAST(d AS DOUBLE) / (CAST(n AS DOUBLE) * (n - d)) END)
  OVER (PARTITION BY cohort ORDER BY t) AS v FROM r
UNION ALL SELECT cohort, 0.0, CAST(sum(d + c) AS BIGINT), 0, 0, 1.0, 0.0 FROM k GROUP BY cohort)"""


def _limit(sign: str) -> str:
    z = survival.Z_95
    power = f"exp({sign}{z} * sqrt(v) / ln(CASE WHEN s > 0 AND s < 1 THEN s END))"
    return f"round(coalesce(pow(s, {power}), s), 9)"


def _curve_rows(cohort: str, keep: str = "true") -> str:
    return (
        f"SELECT cohort, t, at_risk, d, c, round(s, 9) AS survival, {_limit('-')} AS lower, {_limit('')} AS upper "
        f"FROM {curve_sql(cohort, keep)} q"
    )


def _at(month: int) -> str:
    return f"round(coalesce(arg_max(s, t) FILTER (WHERE t <= {month}), 1.0), 4)"


def summary_sql(cohort: str, keep: str = "true") -> str:
    parts = ", ".join(f"{_at(m)} AS retention_{m}m" for m in survival.HORIZONS)
    return (
        f"SELECT cohort, min(t) FILTER (WHERE s <= 0.5) AS median_tenure_months, {parts} "
        f"FROM {curve_sql(cohort, keep)} q GROUP BY cohort"
    )


def _steady(curve):
    """Curves at nine digits: running products differ in the last one or two."""
    return curve.withColumns({c: F.round(c, 9) for c in ("survival", "lower", "upper") if c in curve.columns})


_ROLE = (
    f"role IN (SELECT role FROM {SPELLS} w GROUP BY role ORDER BY count(*) DESC, role LIMIT 8)"
)
_YEAR = f"joining_year IN (SELECT joining_year FROM {SPELLS} w GROUP BY joining_year HAVING count(*) >= 30)"
_DEPT = f"department IN (SELECT department FROM {SPELLS} w GROUP BY department HAVING count(*) >= 20)"
_TIERS = ("Tier-1", "Tier-2", "Tier-3")
_TIER_SUMMARY = summary_sql("college_tier")

_LOGRANK = f"""WITH k AS (SELECT college_tier AS g, tenure_months AS t, sum(event) AS d, count(*) AS m
 FROM {SPELLS} sp GROUP BY 1, 2),
 grid AS (SELECT g, t, coalesce(d, 0) AS d, coalesce(m, 0) AS m FROM (SELECT DISTINCT t FROM k) a
  CROSS JOIN (SELECT DISTINCT g FROM k) b LEFT JOIN k USING (g, t)),
 r AS (SELECT *, CAST(sum(m) OVER (PARTITION BY g ORDER BY t DESC) AS DOUBLE) AS n FROM grid),
 p AS (SELECT a.g AS group_1, b.g AS group_2, a.d AS d1, a.d + b.d AS d, a.n AS n1, b.n AS n2, a.n + b.n AS n
  FROM r a JOIN r b ON a.t = b.t AND a.g < b.g)
SELECT group_1, group_2, round(pow(sum(d1 - d * n1 / n), 2)
 / sum(CASE WHEN n > 1 THEN d * n1 * n2 * (n - d) / (n * n * (n - 1)) END), 4) AS test_stat
FROM p WHERE n > 0 GROUP BY group_1, group_2"""
# The tail of the normal distribution by Simpson's rule over eight units, 4,000 steps.
_TAIL = """(SELECT 2 / sqrt(pi()) * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
 * exp(-pow(sqrt(stat / 2) + i * 0.002, 2))) * 0.002 / 3 FROM range(4001) r(i))"""
_LOGRANK_TEST = f"""SELECT group_1, group_2, round(stat, 4) AS test_stat, round({_TAIL}, 6) AS p_value,
 CASE WHEN {_TAIL} < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM ({_LOGRANK.replace("round(pow(", "(pow(").replace(", 4) AS test_stat", ") AS stat")}) x"""


def _executive_sql() -> str:
    lines = [
        "SELECT 'Median Retention (months)' AS metric, coalesce(CAST(round(median_tenure_months, 1) AS VARCHAR), "
        "'Not reached') AS value FROM o"
    ]
    lines += [
        f"SELECT 'Retention at {m} months (%)', CAST(round(retention_{m}m * 100, 1) AS VARCHAR) FROM o"
        for m in survival.HORIZONS
    ]
    lines += [
        "SELECT 'Best Retention College Tier', (SELECT cohort FROM t ORDER BY retention_36m DESC, cohort LIMIT 1)",
        "SELECT 'Worst Retention College Tier', (SELECT cohort FROM t ORDER BY retention_36m, cohort LIMIT 1)",
    ]
    overall = summary_sql("'Overall'")
    return f"WITH o AS ({overall}), t AS ({_TIER_SUMMARY}) {' UNION ALL '.join(lines)}"


QUERIES = {
    # --- manager scorecard ---
    "m1_team_size": (
        lambda b: managers.team_size(b.employees),
        f"SELECT manager_id, count(*) AS team_size {TEAM}",
    ),
    "m2_attrition": (lambda b: managers.team_attrition(b.employees, even=True), ATTRITION),
    "m3_rating": (lambda b: managers.team_rating(b.employees, b.performance, even=True), RATING),
    "m4_latest_salary": (lambda b: managers.team_latest_salary(b.employees, b.compensation), SALARY),
    "m5_learning": (lambda b: managers.team_learning(b.employees, b.learning, even=True), LEARNING),
    "m6_promotions": (
        lambda b: managers.team_promotions(b.employees, b.performance, "promotions", even=True),
        PROMOTION,
    ),
    "m7_scorecard": (lambda b: b.card, CARD),
    "m8_risk_rank": (
        lambda b: managers.scorecard_ranks(b.card),
        f"SELECT manager_id, attrition_rate_pct, risk_rank FROM ({CARD}) c",
    ),
    "m9_benchmark": (
        lambda b: managers.scorecard_benchmark(b.card),
        "SELECT manager_id, attrition_rate_pct, company_avg_attrition_pct, variance_from_avg, manager_flag "
        f"FROM ({CARD}) c",
    ),
    "m10_composite_risk": (
        lambda b: managers.composite_risk(b.card),
        f"SELECT manager_id, composite_risk_score FROM ({CARD}) c",
    ),
    "m11_manager_counts": (
        lambda b: managers.counts(b.card),
        "SELECT count(*) AS total_managers, any_value(company_avg_attrition_pct) AS company_avg_attrition_pct, "
        f"count(*) FILTER (WHERE manager_flag = '{HIGH}') AS high_risk_managers, "
        f"count(*) FILTER (WHERE manager_flag = '{STAR}') AS star_managers FROM ({CARD}) c",
    ),
    "m12_highest_risk": (
        lambda b: managers.highest_risk(b.card),
        "SELECT manager_id, team_size, exits, attrition_rate_pct, avg_team_rating, variance_from_avg, manager_flag "
        f"FROM ({CARD}) c ORDER BY attrition_rate_pct DESC, manager_id LIMIT 10",
    ),
    "m13_stars": (
        lambda b: managers.stars(b.card),
        "SELECT manager_id, team_size, attrition_rate_pct, avg_team_rating, promotion_rate_pct, total_learning_hours "
        f"FROM ({CARD}) c ORDER BY attrition_rate_pct, avg_team_rating DESC NULLS LAST, manager_id LIMIT 10",
    ),
    "m14_flag_distribution": (
        lambda b: managers.flag_distribution(b.card),
        "SELECT manager_flag, count(*) AS managers, "
        f"{half_even('count(*)', 'CAST(sum(count(*)) OVER () AS HUGEINT)', 1, 100)} AS percentage "
        f"FROM ({CARD}) c GROUP BY manager_flag",
    ),
    "m15_attrition_quartiles": (
        lambda b: managers.attrition_quartiles(b.card).withColumn("std", F.round("std", 6)),
        "SELECT 'attrition_rate_pct' AS column_name, count(*) AS \"count\", "
        f"{dbl('sum(CAST(a AS DECIMAL(5,2)))')} / count(*) AS mean, round(stddev_samp(a), 6) AS std, min(a) AS min, "
        "quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS median, quantile_cont(a, 0.75) AS q3, max(a) AS max "
        f"FROM (SELECT attrition_rate_pct AS a FROM ({CARD}) c) x",
    ),
    # --- survival ---
    "t1_survival_input": (
        lambda b: b.survival,
        f"SELECT * REPLACE ({big('age')} AS age, {big('event')} AS event) FROM {SPELLS} s",
    ),
    "t2_kaplan_meier": (
        lambda b: survival.by_college_tier(b.survival).select("cohort", "t", "at_risk", "d", "c"),
        f"SELECT cohort, t, at_risk, d, c FROM {curve_sql('college_tier')} q",
    ),
    "t3_confidence_band": (
        lambda b: _steady(survival.confidence_band(survival.by_college_tier(b.survival))),
        f"SELECT cohort, t, survival, lower, upper FROM ({_curve_rows('college_tier')}) q",
    ),
    "t4_retention_at_36": (
        lambda b: survival.retention_at(survival.by_college_tier(b.survival), 36),
        f"SELECT cohort, {_at(36)} AS retention FROM {curve_sql('college_tier')} q GROUP BY cohort",
    ),
    "t5_cohort_summary": (
        lambda b: survival.summary(survival.by_college_tier(b.survival)),
        _TIER_SUMMARY,
    ),
    "t6_overall_curve": (lambda b: _steady(survival.overall(b.survival)), _curve_rows("'Overall'")),
    "t7_college_tier_curves": (
        lambda b: _steady(survival.by_college_tier(b.survival)),
        _curve_rows("college_tier"),
    ),
    "t8_role_summary": (
        lambda b: survival.summary(survival.by_role(b.survival)),
        summary_sql("role", _ROLE),
    ),
    "t8_role_curves": (lambda b: _steady(survival.by_role(b.survival)), _curve_rows("role", _ROLE)),
    "t9_joining_year_summary": (
        lambda b: survival.summary(survival.by_joining_year(b.survival)),
        summary_sql("joining_year", _YEAR),
    ),
    "t10_department_summary": (
        lambda b: survival.summary(survival.by_department(b.survival)),
        summary_sql("department", _DEPT),
    ),
    "t11_logrank_statistic": (
        lambda b: survival.logrank_statistics(b.survival, "college_tier").withColumn(
            "test_stat", F.round("test_stat", 4)
        ),
        _LOGRANK,
    ),
    "t11_logrank_test": (lambda b: survival.logrank_test(b.survival), _LOGRANK_TEST),
    "t12_curves_by_tier": (
        lambda b: _rounded_all(survival.wide(survival.by_college_tier(b.survival), _TIERS)),
        "SELECT t, "
        + ", ".join(f"round(any_value(s) FILTER (WHERE cohort = '{g}'), 9) AS \"{g}\"" for g in _TIERS)
        + f" FROM {curve_sql('college_tier')} q GROUP BY t",
    ),
    "t13_executive_summary": (
        lambda b: _executive(b),
        _executive_sql(),
    ),
    "t14_tier_order": (
        lambda b: survival.tier_order(survival.summary(survival.by_college_tier(b.survival))),
        f"SELECT cohort, retention_36m FROM ({_TIER_SUMMARY}) s",
    ),
}


def _executive(b: Bound):
    spells = written(b.survival.select("college_tier", "tenure_months", "event"), "spells")
    tiers = survival.summary(survival.by_college_tier(spells))
    return survival.executive_summary(survival.summary(survival.overall(spells)), tiers)


def _rounded_all(df):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 9) for c in df.columns if c != "t"})
