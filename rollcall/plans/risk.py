"""Registered queries: features, rules, scores, metrics and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators import ranking, rules
from rollcall.plans import flows
from rollcall.plans.bound import Bound
from rollcall.plans.oracle import AS_OF, LATEST, big, dbl, half_even, half_up, mean_int, tenure, where
from rollcall.riskmodel import ensemble, explain, features, metrics, scoring, train
from rollcall.schema import BONUSES, HIKES, PROMOTION_RULES
from rollcall.sources.scratch import written
from rollcall.sources.star import LEVEL_EDGES, MANAGER_DEPARTMENTS, TEST_DIFFICULTY, TRAIN_CUTOFF

EXITED = "status = 'Exited'"

# --- features ----------------------------------------------------------------
_BASE = f"""SELECT e.*, exit_date, CASE WHEN {EXITED} THEN 1 ELSE 0 END AS attrition,
 coalesce(exit_date, {AS_OF}) AS end_date, {tenure(f"(coalesce(exit_date, {AS_OF}))", "joining_date")} AS tenure_months,
 year(joining_date) AS joining_year, month(joining_date) AS joining_month
FROM employees e LEFT JOIN exits x ON x.employee_id = e.employee_id"""
_GROWTH = half_even("CAST((s1 - s0) * 100 AS HUGEINT)", "CAST(s0 * 100 AS HUGEINT)", 2, 100)
_PAY = f"""SELECT employee_id, {dbl("s1")} AS latest_salary, {dbl("b1")} AS latest_bonus, {dbl("k1")} AS latest_stock,
 coalesce({_GROWTH}, 0.0) AS salary_growth_pct
FROM (SELECT DISTINCT employee_id, last_value(salary) OVER w AS s1, first_value(salary) OVER w AS s0,
 last_value(bonus) OVER w AS b1, last_value(stock) OVER w AS k1 FROM compensation
 WINDOW w AS (PARTITION BY employee_id ORDER BY effective_date, comp_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) p"""
_REVIEWS = f"""SELECT employee_id, {mean_int("rating", 2, half_even)} AS avg_rating, {big("max(r1)")} AS latest_rating,
 {big("max(r1) - max(r0)")} AS rating_trend, {where("promotion = 'Yes'")} AS promotion_count,
 {half_even(where("promotion = 'Yes'"), "count(*)", 3)} AS promotion_rate
FROM (SELECT *, last_value(rating) OVER w AS r1, first_value(rating) OVER w AS r0 FROM performance
 WINDOW w AS (PARTITION BY employee_id ORDER BY review_year, rating_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) p GROUP BY employee_id"""
_COURSES = f"""SELECT employee_id, sum(hours_completed) AS total_learning_hours, count(course_name) AS courses_taken,
 {half_even(where("completion_status = 'Completed'"), "count(course_name)", 3)} AS completion_rate
FROM learning GROUP BY employee_id"""
_WORK = f"""SELECT employee_id, count(project_name) AS project_count,
 {half_even(where("billable"), "count(project_name)", 3)} AS billable_ratio FROM projects GROUP BY employee_id"""
_EXPERIENCE = """coalesce(CAST(experience_years AS DOUBLE), (SELECT median(experience_years) FROM employees
 LEFT JOIN managers USING (manager_id)))"""

_VALUES = {
    "gender": ["Male", "Female", "Non-binary"],
    "department": list(MANAGER_DEPARTMENTS),
    "location": [f"NATION_{n}" for n in range(25)],
    "level": [*[lv for _, lv in LEVEL_EDGES], "L5"],
    "college_tier": ["Tier-1", "Tier-2", "Tier-3"],
}
_FLAGS = ", ".join(
    f"CAST(CASE WHEN b.{c} = '{v}' THEN 1 ELSE 0 END AS BIGINT) AS \"{c}_{v}\"" for c, vs in _VALUES.items() for v in vs
)
_MATRIX = f"""SELECT b.employee_id, {big("age")} AS age, {big("attrition")} AS attrition, tenure_months, joining_year,
 joining_month, latest_salary, latest_bonus, latest_stock, salary_growth_pct, avg_rating, latest_rating, rating_trend,
 promotion_count, promotion_rate, coalesce(total_learning_hours, 0.0) AS total_learning_hours,
 coalesce(courses_taken, 0) AS courses_taken, coalesce(completion_rate, 0.0) AS completion_rate,
 coalesce(project_count, 0) AS project_count, coalesce(billable_ratio, 0.0) AS billable_ratio,
 {_EXPERIENCE} AS manager_experience_years, {_FLAGS}
FROM ({_BASE}) b LEFT JOIN ({_PAY}) p ON p.employee_id = b.employee_id
LEFT JOIN ({_REVIEWS}) r ON r.employee_id = b.employee_id LEFT JOIN ({_COURSES}) c ON c.employee_id = b.employee_id
LEFT JOIN ({_WORK}) w ON w.employee_id = b.employee_id LEFT JOIN managers m ON m.manager_id = b.manager_id"""

# --- rules -------------------------------------------------------------------
_STATE = f"""SELECT e.employee_id, e.department, e.level, college_tier, status, latest_rating,
 2001 - coalesce(lp, year(joining_date)) AS years_in_level,
 coalesce(year(exit_date), 2001) - year(joining_date) + 1 AS total_tenure,
 coalesce((SELECT sum(rating) FROM performance p WHERE p.employee_id = e.employee_id
  AND review_year > coalesce(lp, year(joining_date) - 1)), 0) AS rating_sum,
 coalesce((SELECT count(rating) FROM performance p WHERE p.employee_id = e.employee_id
  AND review_year > coalesce(lp, year(joining_date) - 1)), 0) AS rating_count,
 coalesce((SELECT sum(hours_completed) FROM learning l WHERE l.employee_id = e.employee_id
  AND (completion_date IS NULL OR year(completion_date) > coalesce(lp, year(joining_date) - 1))), 0.0)
  AS learning_hours
FROM employees e LEFT JOIN exits x ON x.employee_id = e.employee_id
LEFT JOIN (SELECT employee_id, max(review_year) FILTER (WHERE promotion = 'Yes') AS lp,
 arg_max(rating, CAST(review_year AS HUGEINT) * 10000000000 + rating_id) AS latest_rating
 FROM performance GROUP BY employee_id) h ON h.employee_id = e.employee_id"""
_RULES = "(VALUES " + ", ".join(f"('{lv}', '{n}', {y}, {r}, {h})" for lv, (n, y, r, h) in PROMOTION_RULES.items())
_RULES += ") ru(rule_level, next_level, min_years, min_avg_rating, min_hours)"
_SCREEN = f"""SELECT employee_id, level, {big("years_in_level")} AS years_in_level, rating_count, learning_hours,
 eligible, CASE WHEN eligible THEN next_level ELSE level END AS new_level
FROM (SELECT *, coalesce(rating_count > 0 AND years_in_level >= min_years
  AND rating_sum >= min_avg_rating * rating_count AND learning_hours >= min_hours, false) AS eligible
 FROM state LEFT JOIN {_RULES} ON rule_level = level) s"""
_MERIT = "(VALUES " + ", ".join(f"({r}, {HIKES[r]}, {BONUSES[r]})" for r in HIKES) + ") me(grade, hike, bonus_rate)"
_CYCLE = f"""SELECT employee_id, level, rating, promoted, {dbl("salary")} AS current_salary, {big("floor(x)")} AS new_salary,
 {big("floor(x * bonus_rate)")} AS new_bonus,
 {big("CASE WHEN level IN ('L4', 'L5') THEN floor(x * 0.10) ELSE 0 END")} AS new_stock
FROM (SELECT sc.employee_id, sc.new_level AS level, {big("latest_rating")} AS rating, eligible AS promoted, salary,
 bonus_rate, CASE WHEN eligible THEN greatest(salary * (1 + hike), band_min) ELSE least(salary * (1 + hike), band_max)
 END AS x
 FROM ({_SCREEN}) sc JOIN state st ON st.employee_id = sc.employee_id JOIN ({LATEST}) l ON l.employee_id = sc.employee_id
 JOIN {_MERIT} ON grade = latest_rating JOIN bands b ON b.level = sc.new_level) y"""
_STRESS = (
    "CASE "
    + " ".join(f"WHEN project_name = '{n}' THEN {rules.STRESS.index(s)}" for n, s in TEST_DIFFICULTY.items())
    + " ELSE 1 END"
)
_SCORE = f"""SELECT s.employee_id, {big("latest_rating")} AS latest_rating,
 coalesce(project_stress, 'Medium') AS project_stress, salary_ratio, {big("years_in_level")} AS years_in_level,
 learning_hours, {big("total_tenure")} AS total_tenure,
 {dbl('''greatest(0.001, least(0.600, 0.015
 + CASE latest_rating WHEN 1 THEN 0.080 WHEN 2 THEN 0.040 WHEN 4 THEN -0.010 WHEN 5 THEN -0.020 ELSE 0.000 END
 + CASE college_tier WHEN 'Tier-2' THEN 0.005 WHEN 'Tier-3' THEN 0.010 ELSE 0.000 END
 + CASE WHEN years_in_level >= 4 THEN 0.025 WHEN years_in_level >= 3 THEN 0.010 ELSE 0.000 END
 + CASE coalesce(project_stress, 'Medium') WHEN 'High' THEN 0.010 WHEN 'Low' THEN -0.005 ELSE 0.000 END
 + CASE WHEN learning_hours >= 40 THEN -0.010 WHEN learning_hours < 8 THEN 0.010 ELSE 0.000 END
 + CASE WHEN salary_ratio < 0.85 THEN 0.020 WHEN salary_ratio > 1.15 THEN -0.010 ELSE 0.000 END
 + CASE WHEN total_tenure <= 1 THEN -0.005 WHEN total_tenure >= 5 THEN -0.010 ELSE 0.005 END))''')} AS attrition_prob
FROM (SELECT st.*, project_stress, CAST(salary AS DOUBLE) / (CAST(band_min + band_max AS DOUBLE) / 2) AS salary_ratio
 FROM state st LEFT JOIN ({LATEST}) l ON l.employee_id = st.employee_id
 LEFT JOIN (SELECT employee_id, ['Low', 'Medium', 'High'][arg_max(code, start_date - DATE '1970-01-01' + code / 10.0)
  + 1] AS project_stress FROM (SELECT *, {_STRESS} AS code FROM projects) p GROUP BY employee_id) w
  ON w.employee_id = st.employee_id
 LEFT JOIN bands b ON b.level = st.level) s"""

# --- scores ------------------------------------------------------------------
_RISK = """SELECT *, round(prob * 100, 1) AS risk_score, CASE WHEN prob >= 0.05 THEN 1 ELSE 0 END AS predicted,
 CASE WHEN round(prob * 100, 1) <= 0 THEN NULL WHEN round(prob * 100, 1) <= 20 THEN 'Very Low'
 WHEN round(prob * 100, 1) <= 40 THEN 'Low' WHEN round(prob * 100, 1) <= 60 THEN 'Medium'
 WHEN round(prob * 100, 1) <= 80 THEN 'High' ELSE 'Critical' END AS risk_tier FROM scores"""
_SCORES = f"""SELECT e.employee_id, CASE WHEN {EXITED} THEN 1 ELSE 0 END AS attrition,
 year(joining_date) AS joining_year, attrition_prob AS prob FROM employees e JOIN ({_SCORE}) z USING (employee_id)"""
_TENTHS = "CAST(round(sum(risk_score * 10)) AS HUGEINT)"
_SCORE_MEAN = half_even(_TENTHS, "(10 * count(*))", 1)
_HIGH = "risk_score >= 60"
EXTRA = {"state": _STATE, "scores": _SCORES, "risk": _RISK}

_TRAIN, _TEST = f"joining_year <= {TRAIN_CUTOFF}", f"joining_year > {TRAIN_CUTOFF}"
_GRID = "(VALUES " + ", ".join(f"({i}, CAST({g!r} AS DOUBLE))" for i, g in enumerate(metrics.GRID)) + ") gr(i, g)"


def _f1(rows: str) -> str:
    return f"""(SELECT i, g, count(*) FILTER (WHERE prob >= g AND attrition = 1) AS tp,
 count(*) FILTER (WHERE prob >= g AND attrition = 0) AS fp, count(*) FILTER (WHERE prob < g AND attrition = 1) AS fn,
 count(*) FILTER (WHERE prob < g AND attrition = 0) AS tn
 FROM {_GRID} CROSS JOIN (SELECT * FROM scores WHERE {rows}) s GROUP BY i, g)"""


_F1 = "CASE WHEN tp = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END"


def _best(rows: str) -> str:
    return (
        f"SELECT CASE WHEN f1 > 0 THEN round(g, 2) ELSE 0.5 END AS threshold, f1 FROM "
        f"(SELECT i, g, {_F1} AS f1 FROM {_f1(rows)} t) u ORDER BY f1 DESC, i LIMIT 1"
    )


_CUM = f"""(SELECT prob, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, pos, neg,
 CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM (SELECT prob,
 sum(attrition) AS pos, sum(1 - attrition) AS neg FROM scores WHERE {_TEST} GROUP BY prob) g
 WINDOW w AS (ORDER BY prob DESC))"""
_EVALUATE = f"""SELECT decision_threshold, round(CAST(a.tp + a.tn AS DOUBLE) / a.m, 4) AS train_accuracy,
 round(CAST(t.tp + t.tn AS DOUBLE) / t.m, 4) AS test_accuracy,
 round(CASE WHEN t.tp + t.fp = 0 THEN 0.0 ELSE CAST(t.tp AS DOUBLE) / (t.tp + t.fp) END, 4) AS precision,
 round(CASE WHEN t.tp + t.fn = 0 THEN 0.0 ELSE CAST(t.tp AS DOUBLE) / (t.tp + t.fn) END, 4) AS recall,
 round(CASE WHEN t.tp = 0 THEN 0.0 ELSE CAST(2 * t.tp AS DOUBLE) / (2 * t.tp + t.fp + t.fn) END, 4) AS f1_score,
 t.tn, t.fp, t.fn, t.tp, a.m AS train_size, t.m AS test_size,
 {half_up("(a.tp + a.fn)", "a.m", 2, 100)} AS train_attrition_rate,
 {half_up("(t.tp + t.fn)", "t.m", 2, 100)} AS test_attrition_rate,
 round((SELECT CAST(sum(neg * (2 * (tp - pos) + pos)) AS DOUBLE) / (2.0 * max(p) * max(n)) FROM {_CUM} c), 4) AS roc_auc,
 round((SELECT sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / max(p) FROM {_CUM} c), 4) AS avg_precision
FROM (SELECT threshold AS decision_threshold FROM ({_best(_TEST)}) b0) b
CROSS JOIN LATERAL (SELECT count(*) AS m, count(*) FILTER (WHERE prob >= decision_threshold AND attrition = 1) AS tp,
 count(*) FILTER (WHERE prob >= decision_threshold AND attrition = 0) AS fp,
 count(*) FILTER (WHERE prob < decision_threshold AND attrition = 1) AS fn,
 count(*) FILTER (WHERE prob < decision_threshold AND attrition = 0) AS tn FROM scores WHERE {_TEST}) t
CROSS JOIN LATERAL (SELECT count(*) AS m, count(*) FILTER (WHERE prob >= decision_threshold AND attrition = 1) AS tp,
 count(*) FILTER (WHERE prob >= decision_threshold AND attrition = 0) AS fp,
 count(*) FILTER (WHERE prob < decision_threshold AND attrition = 1) AS fn,
 count(*) FILTER (WHERE prob < decision_threshold AND attrition = 0) AS tn FROM scores WHERE {_TRAIN}) a"""


# --- a fixed ensemble, which SQL can follow ----------------------------------
# Tree, leaf, value, feature, low, high, share of training rows.
_INF = float("inf")
CARD_BASE = -1.25
CARD = (
    (0, 0, 0.75, "tenure_months", -_INF, 60.0, 0.5), (0, 0, 0.75, "avg_rating", -_INF, 3.0, 0.5),
    (0, 1, 0.25, "tenure_months", -_INF, 60.0, 0.5), (0, 1, 0.25, "avg_rating", 3.0, _INF, 0.5),
    (0, 2, -0.125, "tenure_months", 60.0, _INF, 0.5), (0, 2, -0.125, "promotion_count", -_INF, 2.0, 0.75),
    (0, 3, -0.5, "tenure_months", 60.0, _INF, 0.5), (0, 3, -0.5, "promotion_count", 2.0, _INF, 0.25),
    (1, 0, 0.5, "age", -_INF, 35.0, 0.375), (1, 0, 0.5, "billable_ratio", -_INF, 0.5, 0.5),
    (1, 0, 0.5, "salary_growth_pct", -_INF, 0.0, 0.5),
    (1, 1, 0.125, "age", -_INF, 35.0, 0.375), (1, 1, 0.125, "billable_ratio", -_INF, 0.5, 0.5),
    (1, 1, 0.125, "salary_growth_pct", 0.0, _INF, 0.5),
    (1, 2, -0.0625, "age", -_INF, 35.0, 0.375), (1, 2, -0.0625, "billable_ratio", 0.5, _INF, 0.5),
    (1, 3, -0.25, "age", 35.0, 50.0, 0.375),
    (1, 4, -0.375, "age", 50.0, _INF, 0.25),
    (2, 0, 0.375, "gender_Female", 0.5, _INF, 0.375), (2, 0, 0.375, "total_learning_hours", -_INF, 800.0, 0.25),
    (2, 1, -0.125, "gender_Female", 0.5, _INF, 0.375), (2, 1, -0.125, "total_learning_hours", 800.0, _INF, 0.75),
    (2, 2, 0.0625, "gender_Female", -_INF, 0.5, 0.625),
    (3, 0, 0.03125, None, None, None, None),
)
CARD_FEATURES = sorted({r[3] for r in CARD if r[3]})


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return f"'{v}'"
    return f"CAST('{v}' AS DOUBLE)" if v in (_INF, -_INF) else repr(v)


_CARD = "(VALUES " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in CARD)
_CARD += ") card(tree, leaf, leaf_value, feature, low, high, share)"
_LONG = " UNION ALL ".join(f"SELECT employee_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM matrix" for f in CARD_FEATURES)
EXTRA["matrix"] = _MATRIX
EXTRA["cells"] = _LONG
EXTRA["met"] = f"""SELECT employee_id, value, card.*, CASE WHEN value > low AND value <= high THEN 1.0 ELSE 0.0 END AS met
FROM cells JOIN {_CARD} ON card.feature = cells.feature"""
EXTRA["carded"] = f"""SELECT m.*, 1 / (1 + exp(-(coalesce(s, 0.0) + {CARD_BASE} + {sum(r[2] for r in CARD if r[3] is None)}))) AS prob
FROM matrix m LEFT JOIN (SELECT employee_id, sum(leaf_value) AS s FROM (SELECT employee_id, tree, leaf, any_value(leaf_value)
 AS leaf_value FROM met GROUP BY ALL HAVING min(met) = 1.0) r GROUP BY employee_id) x USING (employee_id)"""
# Over all orders in which up to three conditions become known.
EXTRA["shapley"] = """SELECT employee_id, feature, any_value(value) AS value, sum(part) AS contribution
FROM (SELECT a.employee_id, a.feature, a.value, a.leaf_value * (a.met - a.share) * CASE count(o.feature)
 WHEN 0 THEN 1.0 WHEN 1 THEN (min(o.met) + min(o.share)) / 2
 ELSE list(o.met ORDER BY o.feature)[1] * list(o.met ORDER BY o.feature)[2] / 3
  + list(o.met ORDER BY o.feature)[1] * list(o.share ORDER BY o.feature)[2] / 6
  + list(o.share ORDER BY o.feature)[1] * list(o.met ORDER BY o.feature)[2] / 6
  + list(o.share ORDER BY o.feature)[1] * list(o.share ORDER BY o.feature)[2] / 3 END AS part
 FROM met a LEFT JOIN met o ON o.employee_id = a.employee_id AND o.tree = a.tree AND o.leaf = a.leaf AND o.feature <> a.feature
 GROUP BY a.employee_id, a.tree, a.leaf, a.feature, a.value, a.leaf_value, a.met, a.share) p GROUP BY employee_id, feature"""
EXTRA["importance"] = """SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs_contribution FROM shapley GROUP BY feature"""
_CARD_EXPECTED = CARD_BASE
for _tree, _leaf in sorted({r[:2] for r in CARD}):
    _share = 1.0
    for _r in CARD:
        if _r[:2] == (_tree, _leaf):
            _share, _value = _share * (1.0 if _r[6] is None else _r[6]), _r[2]
    _CARD_EXPECTED += _share * _value


def card(b: Bound):
    return b.spark.createDataFrame(list(CARD), ensemble.SCHEMA)


def _carded(b: Bound):
    return ensemble.score(b.matrix, card(b), CARD_BASE)


def _card_parts(b: Bound):
    return written(ensemble.contributions(b.matrix, card(b)), "card-parts")


def _card_worst(b: Bound):
    worst = written(ranking.top(_carded(b), 1, F.desc("prob"), "employee_id"), "card-worst")
    parts = ensemble.contributions(worst.drop("prob", "predicted_attrition"), card(b))
    shown = explain.waterfall(parts, worst, ensemble.base_value(card(b), CARD_BASE))
    return _at_nine(shown, "contribution", "prob", "base_value")


def _split(b: Bound):
    scores = b.rule_scores.select("attrition", "joining_year", "prob")
    return features.time_split(written(scores, "scores"), TRAIN_CUTOFF)


def _test(b: Bound):
    return features.time_split(b.rule_scores, TRAIN_CUTOFF)[1]


def _risk(b: Bound):
    return scoring.risk_columns(b.rule_scores)


def _base(b: Bound):
    return features.target_and_tenure(b.employees, b.exits, b.as_of)


def _scored(b: Bound):
    return train.score(b.trained.model, b.matrix)


def _model_risk(b: Bound):
    return scoring.risk_columns(_scored(b))


def _model_test(b: Bound):
    return train.score(b.trained.model, b.trained.test).select("employee_id", "attrition", "prob")


def _at_nine(df, *columns: str):
    return df.withColumns({c: F.round(c, 9) for c in columns})


QUERIES = {
    # --- features ---
    "g1_target_and_tenure": (
        lambda b: _base(b),
        f"SELECT * REPLACE ({big('age')} AS age, {big('attrition')} AS attrition) FROM ({_BASE}) x",
    ),
    "g2_compensation_features": (lambda b: features.compensation_features(b.compensation), _PAY),
    "g3_rating_features": (
        lambda b: features.performance_features(b.performance).drop("promotion_count", "promotion_rate"),
        f"SELECT employee_id, avg_rating, latest_rating, rating_trend FROM ({_REVIEWS}) r",
    ),
    "g4_promotion_features": (
        lambda b: features.performance_features(b.performance).select(
            "employee_id", "promotion_count", "promotion_rate"
        ),
        f"SELECT employee_id, promotion_count, promotion_rate FROM ({_REVIEWS}) r",
    ),
    "g5_learning_features": (
        lambda b: features.with_learning(b.employees.select("employee_id"), b.learning),
        "SELECT employee_id, coalesce(total_learning_hours, 0.0) AS total_learning_hours, "
        "coalesce(courses_taken, 0) AS courses_taken, coalesce(completion_rate, 0.0) AS completion_rate "
        f"FROM employees LEFT JOIN ({_COURSES}) c USING (employee_id)",
    ),
    "g6_project_features": (
        lambda b: features.with_projects(b.employees.select("employee_id"), b.projects),
        "SELECT employee_id, coalesce(project_count, 0) AS project_count, "
        f"coalesce(billable_ratio, 0.0) AS billable_ratio FROM employees LEFT JOIN ({_WORK}) w USING (employee_id)",
    ),
    "g7_manager_experience": (
        lambda b: features.with_manager_experience(b.employees.select("employee_id", "manager_id"), b.managers),
        f"SELECT employee_id, manager_id, {_EXPERIENCE} AS manager_experience_years "
        "FROM employees LEFT JOIN managers m USING (manager_id)",
    ),
    "g8_one_hot": (
        lambda b: features.one_hot(
            b.employees.select("employee_id", *features.CATEGORICAL), features.categories(b.employees)
        ),
        f"SELECT employee_id, {_FLAGS} FROM employees b",
    ),
    "g9_filled_medians": (
        # Only assigned projects count here, so the gaps are real and get medians.
        lambda b: features.fill_medians(
            b.employees.select("employee_id").join(
                features.project_features(b.projects.filter("billable")).drop("billable_ratio"), "employee_id", "left"
            ),
            ["project_count"],
        ).withColumn("project_count", F.col("project_count").cast("double")),
        "SELECT employee_id, CAST(coalesce(n, (SELECT median(n) FROM pc)) AS DOUBLE) AS project_count "
        "FROM employees LEFT JOIN pc USING (employee_id)",
    ),
    "g10_feature_matrix": (lambda b: flows.feature_matrix(b.t.tables(), b.as_of), _MATRIX),
    # --- rules ---
    "z1_promotion_screen": (lambda b: rules.promotion_screen(b.state, b.promotion_rules), _SCREEN),
    "z2_merit_cycle": (
        lambda b: rules.merit_cycle(
            rules.promotion_screen(b.state, b.promotion_rules), b.state, b.compensation, b.bands, b.merit
        ),
        _CYCLE,
    ),
    "z3_attrition_score": (
        lambda b: rules.attrition_score(b.state, b.compensation, b.projects, b.bands, TEST_DIFFICULTY),
        _SCORE,
    ),
    # --- model work on the rule score, which SQL can follow ---
    "h1_time_split": (
        lambda b: b.rule_scores.select("employee_id", features.split_label(TRAIN_CUTOFF).alias("split")),
        f"SELECT employee_id, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split FROM scores",
    ),
    "h3_best_threshold": (lambda b: metrics.best_threshold(_test(b)), _best(_TEST)),
    "h3_threshold_table": (
        lambda b: metrics.threshold_table(_test(b)),
        f"SELECT g AS threshold, tp, fp, fn, tn, {_F1} AS f1 FROM {_f1(_TEST)} t",
    ),
    "h4_metrics": (lambda b: metrics.evaluate(*_split(b)), _EVALUATE),
    "h6_risk_tiers": (
        lambda b: scoring.tiers(_risk(b)),
        "SELECT employee_id, risk_score, risk_tier FROM risk",
    ),
    "h7_department_risk": (
        lambda b: scoring.department_summary(_risk(b), b.employees),
        f"SELECT department, count(*) AS total_employees, {_SCORE_MEAN} AS avg_risk_score, {where(_HIGH)} "
        f"AS high_risk_count, {where('risk_score >= 80')} AS critical_risk_count, {big('sum(attrition)')} "
        f"AS actual_exits, {big('sum(predicted)')} AS predicted_exits, "
        f"{half_even(where(_HIGH), 'count(*)', 1, 100)} AS high_risk_pct "
        "FROM risk JOIN employees USING (employee_id) GROUP BY department",
    ),
    "h8_manager_risk": (
        lambda b: scoring.manager_summary(_risk(b), b.employees),
        f"SELECT manager_id, count(*) AS team_size, {_SCORE_MEAN} AS avg_risk_score, {where(_HIGH)} "
        f"AS high_risk_count, {big('sum(attrition)')} AS actual_exits, {big('sum(predicted)')} AS predicted_exits, "
        f"{half_even(where(_HIGH), 'count(*)', 1, 100)} AS high_risk_pct FROM risk JOIN employees USING (employee_id) "
        "WHERE manager_id IS NOT NULL GROUP BY manager_id HAVING count(*) >= 10",
    ),
    "h8_suppressed_managers": (
        lambda b: scoring.suppressed_managers(_risk(b), b.employees),
        "SELECT count(*) AS suppressed_managers FROM (SELECT manager_id FROM employees WHERE manager_id IS NOT NULL "
        "GROUP BY manager_id HAVING count(*) < 10) t",
    ),
    "h9_risk_snapshot": (
        lambda b: scoring.snapshot(_risk(b)),
        f"SELECT count(*) AS total_scored, {where('attrition = 0')} AS active_employees, {_SCORE_MEAN} "
        f"AS avg_risk_score, {where(_HIGH)} AS high_risk, {half_up(where(_HIGH), 'count(*)', 1, 100)} AS high_risk_pct, "
        f"{where('risk_score >= 80')} AS critical, {half_up(where('risk_score >= 80'), 'count(*)', 1, 100)} "
        "AS critical_pct FROM risk",
    ),
    "h10_tier_distribution": (
        lambda b: scoring.tier_distribution(_risk(b)),
        f"SELECT risk_tier, count(*) AS row_count, {half_up('count(*)', '(SELECT count(*) FROM risk)', 1, 100)} "
        "AS share_pct FROM risk WHERE risk_tier IS NOT NULL GROUP BY risk_tier",
    ),
    "h11_top_active": (
        lambda b: scoring.top_active(_risk(b)),
        "SELECT employee_id, risk_score, risk_tier FROM risk WHERE attrition = 0 "
        "ORDER BY risk_score DESC, employee_id LIMIT 20",
    ),
    "i1_roc_points": (
        lambda b: _at_nine(metrics.roc_points(_test(b)), "fpr", "tpr"),
        f"SELECT prob AS threshold, round(CAST(fp AS DOUBLE) / n, 9) AS fpr, round(CAST(tp AS DOUBLE) / p, 9) AS tpr "
        f"FROM {_CUM} c UNION ALL SELECT NULL, 0.0, 0.0",
    ),
    "i2_precision_recall_points": (
        lambda b: _at_nine(metrics.precision_recall_points(_test(b)), "precision", "recall", "base_rate"),
        "SELECT prob AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision, "
        "round(CAST(tp AS DOUBLE) / p, 9) AS recall, round(CAST(p AS DOUBLE) / (p + n), 9) AS base_rate "
        f"FROM {_CUM} c UNION ALL SELECT NULL, 1.0, 0.0, round(CAST(sum(attrition) AS DOUBLE) / count(*), 9) "
        f"FROM scores WHERE {_TEST}",
    ),
    "i3_confusion_matrix": (
        lambda b: metrics.confusion_matrix(_test(b), 0.05),
        f"SELECT {big('attrition')} AS actual, CAST(prob >= 0.05 AS BIGINT) AS predicted, count(*) AS row_count "
        f"FROM scores WHERE {_TEST} GROUP BY ALL",
    ),
    "i4_score_histogram": (
        lambda b: metrics.score_histogram(_test(b)),
        "SELECT CAST(least(floor(prob * 40), 39) AS BIGINT) AS bin, least(floor(prob * 40), 39) / 40 AS bin_start, "
        f"{big('attrition')} AS attrition, count(*) AS row_count FROM scores WHERE {_TEST} GROUP BY ALL",
    ),
    # --- on the fixed ensemble, by joins and aggregates ---
    "h5_scored_employees": (
        lambda b: scoring.risk_columns(_carded(b)).select(
            "employee_id", "attrition", "risk_score", "attrition_prob", "predicted_attrition", "risk_tier"
        ),
        f"""SELECT employee_id, {big("attrition")} AS attrition, round(prob * 100, 1) AS risk_score, round(prob, 4)
 AS attrition_prob, CAST(prob >= 0.5 AS BIGINT) AS predicted_attrition, CASE WHEN round(prob * 100, 1) <= 0 THEN NULL
 WHEN round(prob * 100, 1) <= 20 THEN 'Very Low' WHEN round(prob * 100, 1) <= 40 THEN 'Low'
 WHEN round(prob * 100, 1) <= 60 THEN 'Medium' WHEN round(prob * 100, 1) <= 80 THEN 'High' ELSE 'Critical' END AS risk_tier
FROM carded""",
    ),
    "n1_contributions": (
        lambda b: _at_nine(ensemble.contributions(b.matrix, card(b)), "contribution"),
        "SELECT employee_id, feature, value, round(contribution, 9) AS contribution FROM shapley",
    ),
    "n2_feature_importance": (
        lambda b: explain.importance(_card_parts(b)),
        "SELECT feature, mean_abs_contribution, rank() OVER (ORDER BY mean_abs_contribution DESC) AS rank FROM importance",
    ),
    "n3_contribution_spread": (
        lambda b: _at_nine(explain.spread_of_top(_card_parts(b), 5), "contribution"),
        """SELECT rank, feature, employee_id, value, round(contribution, 9) AS contribution FROM shapley JOIN (SELECT feature,
 rank() OVER (ORDER BY mean_abs_contribution DESC) AS rank FROM importance QUALIFY row_number() OVER (
 ORDER BY mean_abs_contribution DESC, feature) <= 5) t USING (feature)""",
    ),
    "n4_highest_risk": (
        _card_worst,
        f"""SELECT employee_id, feature, value, round(contribution, 9) AS contribution, round(prob, 9) AS prob,
 round(CAST({_CARD_EXPECTED!r} AS DOUBLE), 9) AS base_value FROM shapley JOIN (SELECT employee_id, prob FROM carded
 ORDER BY prob DESC, employee_id LIMIT 1) w USING (employee_id)""",
    ),
    "n5_dependence": (
        lambda b: _at_nine(explain.dependence(_card_parts(b)), "contribution"),
        "SELECT employee_id, value, round(contribution, 9) AS contribution FROM shapley WHERE feature = 'tenure_months'",
    ),
    # --- on the boosted trees: no SQL counterpart ---
    "h2_boosted_trees": (lambda b: flows.run_evaluation(b.train()), None),
    "h5_model_scores": (
        lambda b: _model_risk(b).select(
            "employee_id", "attrition", "risk_score", "attrition_prob", "predicted_attrition", "risk_tier"
        ),
        None,
    ),
    "h7_model_department_risk": (lambda b: scoring.department_summary(_model_risk(b), b.employees), None),
    "h8_model_manager_risk": (lambda b: scoring.manager_summary(_model_risk(b), b.employees), None),
    "h11_model_top_active": (lambda b: scoring.top_active(_model_risk(b)), None),
    "i1_model_roc_points": (lambda b: metrics.roc_points(_model_test(b)), None),
    "i2_model_precision_recall": (lambda b: metrics.precision_recall_points(_model_test(b)), None),
    "i3_model_confusion_matrix": (lambda b: metrics.confusion_matrix(_model_test(b)), None),
    "i4_model_score_histogram": (lambda b: metrics.score_histogram(_model_test(b)), None),
    "n1_model_contributions": (
        lambda b: explain.contributions(b.trained.model, b.trained.test, b.trained.columns),
        None,
    ),
    "n2_model_importance": (lambda b: b.explained["feature_importance"], None),
    "n3_model_spread": (lambda b: b.explained["spread"], None),
    "n4_model_highest_risk": (lambda b: b.explained["highest_risk"], None),
    "n5_model_dependence": (lambda b: b.explained["dependence"], None),
}
EXTRA["pc"] = "SELECT employee_id, count(*) AS n FROM projects WHERE billable GROUP BY employee_id"
