"""Features, rules, metrics, scores and contributions."""

import datetime as dt
import itertools
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions.kernels import add_leaf
from rollcall.operators import rules
from rollcall.plans import flows
from rollcall.plans.bound import Bound
from rollcall.riskmodel import explain, features, metrics, scoring, train
from rollcall.schema import bands_frame, merit_frame, promotion_rules_frame

D = dt.date


def scored(spark, rows):
    return spark.createDataFrame([(i, int(y), float(p)) for i, (y, p) in enumerate(rows)], "employee_id bigint, attrition int, prob double")


# --- features ----------------------------------------------------------------


def test_pay_features_pass_over_nulls_and_zero_start(spark):
    rows = [
        (1, 1, D(2020, 1, 1), Decimal(100)),
        (2, 1, D(2021, 1, 1), Decimal(133)),
        (3, 1, D(2022, 1, 1), None),
        (4, 2, D(2020, 1, 1), Decimal(0)),
        (5, 2, D(2021, 1, 1), Decimal(50)),
    ]
    comp = spark.createDataFrame(rows, "comp_id bigint, employee_id bigint, effective_date date, salary decimal(12,2)")
    comp = comp.withColumn("bonus", F.col("salary")).withColumn("stock", F.col("salary"))
    got = {r["employee_id"]: r for r in features.compensation_features(comp).collect()}
    assert (got[1]["latest_salary"], got[1]["salary_growth_pct"]) == (133.0, 33.0)
    assert got[2]["salary_growth_pct"] == 0.0


def test_missing_history_counts_as_zero_and_gaps_get_medians(spark):
    base = spark.createDataFrame([(1,), (2,)], "employee_id bigint")
    learn = spark.createDataFrame([(1, "c", 8.0, "Completed"), (1, "d", 2.0, "In Progress")], "employee_id bigint, course_name string, hours_completed double, completion_status string")
    got = {r["employee_id"]: tuple(r)[1:] for r in features.with_learning(base, learn).collect()}
    assert got == {1: (10.0, 2, 0.5), 2: (0.0, 0, 0.0)}
    df = spark.createDataFrame([(1.0, 5), (None, 6), (3.0, None), (9.0, 8)], "a double, b int")
    filled = [tuple(r) for r in features.fill_medians(df, ["a", "b"]).collect()]
    assert sorted(filled) == [(1.0, 5.0), (3.0, 6.0), (3.0, 6.0), (9.0, 8.0)]


def test_manager_median_is_over_employees(spark):
    base = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, None)], "employee_id bigint, manager_id string")
    mgr = spark.createDataFrame([("A", 4), ("B", 10)], "manager_id string, experience_years int")
    got = {r["employee_id"]: r["manager_experience_years"] for r in features.with_manager_experience(base, mgr).collect()}
    assert got == {1: 4.0, 2: 4.0, 3: 10.0, 4: 4.0}
    assert features.with_manager_experience(base, None).first()["manager_experience_years"] == 0.0


def test_one_hot_keeps_all_and_ignores_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "g string")
    hot = features.one_hot(df, features.categories(df, ["g"]))
    assert hot.columns == ["g_a", "g_b"]
    assert [tuple(r) for r in hot.collect()] == [(0, 1), (1, 0), (0, 0)]


# --- threshold and curves ----------------------------------------------------


def test_grid_place_equals_counting(spark):
    rng = random.Random(8)
    values = [*metrics.GRID, 0.0, 1.0, *(rng.random() for _ in range(3000))]
    values += [np.nextafter(g, 0) for g in metrics.GRID] + [np.nextafter(g, 1) for g in metrics.GRID]
    df = spark.createDataFrame([(float(v),) for v in values], "p double")
    got = [r[0] for r in df.select(metrics._grid_place(F.col("p"))).collect()]
    assert got == [sum(g <= v for g in metrics.GRID) for v in values]


def brute_threshold(rows):
    best, chosen = 0.0, 0.5
    for g in np.arange(0.05, 0.95, 0.01):
        tp = sum(1 for y, p in rows if y and p >= g)
        fp = sum(1 for y, p in rows if not y and p >= g)
        fn = sum(1 for y, p in rows if y and p < g)
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        if f1 > best:
            best, chosen = f1, g
    return round(float(chosen), 2), best


def test_best_threshold(spark):
    rng = random.Random(4)
    noisy = [(int(rng.random() < 0.3), round(rng.random(), 3)) for _ in range(400)]
    noisy = [(y, min(1.0, p + 0.2 * y)) for y, p in noisy]
    for rows in (noisy, [(0, 0.1), (1, 0.4), (1, 0.8)], [(0, 0.9), (0, 0.2)]):
        row = metrics.best_threshold(scored(spark, rows)).first()
        want = brute_threshold(rows)
        assert (row["threshold"], row["f1"]) == (want[0], pytest.approx(want[1]))


def test_auc_and_average_precision(spark):
    rng = random.Random(6)
    rows = [(int(rng.random() < 0.4), rng.randint(0, 20) / 20) for _ in range(300)]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = last = 0.0
    for s in sorted({p for _, p in rows}, reverse=True):
        tp = sum(p >= s for p in pos)
        recall = tp / len(pos)
        ap += (recall - last) * tp / (tp + sum(p >= s for p in neg))
        last = recall
    row = metrics.ranking_quality(scored(spark, rows)).first()
    assert row["roc_auc"] == pytest.approx(pairs, abs=1e-12)
    assert row["avg_precision"] == pytest.approx(ap, abs=1e-12)


def test_hot_score_is_one_row(spark):
    """A third of all rows share one score."""
    rows = [(i % 2, 0.5 if i % 3 == 0 else i / 1000) for i in range(999)]
    points = metrics.roc_points(scored(spark, rows)).collect()
    assert len(points) == len({p for _, p in rows}) + 1
    assert max(r["tpr"] for r in points) == 1.0 and max(r["fpr"] for r in points) == 1.0


def test_evaluate_matches_counts(spark):
    fit = scored(spark, [(1, 0.9), (0, 0.2), (0, 0.7), (1, 0.1)])
    held = scored(spark, [(1, 0.8), (0, 0.6), (0, 0.1), (1, 0.3), (0, 0.2)])
    row = metrics.evaluate(fit, held, 0.5).first().asDict()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 1, 1, 1)
    assert (row["train_accuracy"], row["test_accuracy"]) == (0.5, 0.6)
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.5, 0.5, 0.5)
    assert (row["train_attrition_rate"], row["test_attrition_rate"]) == (50.0, 40.0)


def test_histogram_counts_every_row(spark):
    rows = [(i % 2, i / 200) for i in range(201)]
    got = metrics.score_histogram(scored(spark, rows)).collect()
    assert sum(r["row_count"] for r in got) == 201 and max(r["bin"] for r in got) == 39


# --- scores ------------------------------------------------------------------


def test_tiers_and_suppression(spark):
    risk = scoring.risk_columns(scored(spark, [(0, 0.0), (0, 0.2), (1, 0.201), (1, 1.0)]).withColumn("predicted_attrition", F.lit(1)))
    assert [r["risk_tier"] for r in risk.orderBy("employee_id").collect()] == [None, "Very Low", "Low", "Critical"]
    emp = spark.createDataFrame([(0, "A"), (1, "A"), (2, "A"), (3, None)], "employee_id bigint, manager_id string")
    assert scoring.manager_summary(risk, emp, k=3).count() == 1
    assert scoring.manager_summary(risk, emp, k=4).count() == 0
    assert scoring.suppressed_managers(risk, emp, k=4).first()[0] == 1
    shares = {r["risk_tier"]: r["share_pct"] for r in scoring.tier_distribution(risk).collect()}
    assert shares == {"Very Low": 25.0, "Low": 25.0, "Critical": 25.0}


# --- rules -------------------------------------------------------------------


def state(spark, rows):
    return spark.createDataFrame(
        rows,
        "employee_id bigint, level string, college_tier string, latest_rating int, years_in_level int, "
        "total_tenure int, rating_sum bigint, rating_count bigint, learning_hours double",
    )


def test_promotion_screen(spark):
    rows = [
        (1, "L1", "Tier-1", 4, 2, 3, 8, 2, 40.0),  # meets every limit exactly
        (2, "L1", "Tier-1", 4, 1, 3, 8, 2, 40.0),
        (3, "L1", "Tier-1", 4, 2, 3, 7, 2, 40.0),
        (4, "L1", "Tier-1", 4, 2, 3, 0, 0, 40.0),
        (5, "L5", "Tier-1", 5, 9, 9, 50, 10, 400.0),
        (6, "L3", "Tier-1", 5, 4, 9, 42, 10, 80.0),
    ]
    got = {r["employee_id"]: (r["eligible"], r["new_level"]) for r in rules.promotion_screen(state(spark, rows), promotion_rules_frame(spark)).collect()}
    assert got == {1: (True, "L2"), 2: (False, "L1"), 3: (False, "L1"), 4: (False, "L1"), 5: (False, "L5"), 6: (True, "L4")}


def test_merit_cycle(spark):
    rows = [(1, "L1", "Tier-1", 5, 0, 1, 5, 1, 0.0), (2, "L1", "Tier-1", 4, 2, 3, 8, 2, 40.0), (3, "L4", "Tier-1", 3, 0, 1, 3, 1, 0.0)]
    st = state(spark, rows)
    comp = spark.createDataFrame(
        [(i, i, D(2020, 1, 1), "L1", Decimal(s), Decimal(0), Decimal(0)) for i, s in ((1, 500000), (2, 500000), (3, 2000001))],
        "comp_id bigint, employee_id bigint, effective_date date, level string, salary decimal(12,2), bonus decimal(12,2), stock decimal(12,2)",
    )
    screen = rules.promotion_screen(st, promotion_rules_frame(spark))
    got = {r["employee_id"]: (r["level"], r["new_salary"], r["new_bonus"], r["new_stock"]) for r in rules.merit_cycle(screen, st, comp, bands_frame(spark), merit_frame(spark)).collect()}
    assert got[1] == ("L1", 550000, 66000, 0)  # capped at the band
    assert got[2] == ("L2", 600000, 48000, 0)  # lifted to the new band
    assert got[3] == ("L4", 2160001, 108000, 216000)


def test_attrition_score_terms_and_clip(spark):
    rows = [
        (1, "L1", "Tier-3", 1, 4, 3, 0, 0, 0.0),
        (2, "L1", "Tier-1", 5, 0, 5, 0, 0, 50.0),
    ]
    comp = spark.createDataFrame(
        [(i, i, D(2020, 1, 1), "L1", Decimal(s), Decimal(0), Decimal(0)) for i, s in ((1, 370000), (2, 550000))],
        "comp_id bigint, employee_id bigint, effective_date date, level string, salary decimal(12,2), bonus decimal(12,2), stock decimal(12,2)",
    )
    proj = spark.createDataFrame(
        [(1, "Calm", D(2020, 1, 1)), (1, "Rush", D(2021, 1, 1)), (1, "Calm", D(2021, 1, 1))],
        "employee_id bigint, project_name string, start_date date",
    )
    got = {
        r["employee_id"]: (r["project_stress"], r["attrition_prob"])
        for r in rules.attrition_score(state(spark, rows), comp, proj, bands_frame(spark), {"Rush": "High", "Calm": "Low"}).collect()
    }
    assert got[1] == ("High", 0.175)  # .015 + .08 + .01 + .025 + .01 + .01 + .02 + .005
    assert got[2] == ("Medium", 0.001)


# --- contributions -----------------------------------------------------------


def test_leaf_values_are_shapley_values():
    """Against the definition, over all orders in which features become known."""
    leaf = (2.0, [(0, -np.inf, 1.0, 0.3), (2, 0.0, np.inf, 0.6), (1, -1.0, 1.0, 0.5)])
    x = np.array([[0.5, 0.0, 1.0], [2.0, 0.0, 1.0], [0.5, 5.0, -1.0]])
    out = np.zeros_like(x)
    add_leaf(x, leaf, out)
    for row, got in zip(x, out):
        want = np.zeros(3)
        orders = list(itertools.permutations([0, 1, 2]))
        for order in orders:
            known = set()

            def worth():
                v = leaf[0]
                for f, low, high, share in leaf[1]:
                    v *= float(low < row[f] <= high) if f in known else share
                return v

            for f in order:
                before = worth()
                known.add(f)
                want[f] += (worth() - before) / len(orders)
        assert np.allclose(got, want)


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        a, b, c = rng.random(), rng.random(), rng.randint(0, 3)
        rows.append((i, float(a), float(b), float(c), int(a + 0.3 * c > 0.9)))
    df = spark.createDataFrame(rows, "employee_id bigint, a double, b double, c double, attrition int").cache()
    return train.train(df, ["a", "b", "c"], rounds=6, rate=0.3, depth=3, leaf=5), df


def test_contributions_add_up_to_the_score(model):
    fitted, df = model
    parts = explain.contributions(fitted, df, ["a", "b", "c"])
    assert parts.count() == 3 * df.count()
    base = explain.base_value(fitted)
    sums = {r[0]: r[1] for r in parts.groupBy("employee_id").agg(F.sum("contribution")).collect()}
    for r in train.score(fitted, df).select("employee_id", "prob").collect():
        assert 1 / (1 + math.exp(-(base + sums[r["employee_id"]]))) == pytest.approx(r["prob"], abs=1e-12)


def test_importance_and_explanations(model):
    fitted, df = model
    parts = explain.contributions(fitted, df, ["a", "b", "c"])
    ranked = explain.importance(parts).collect()
    assert [r["rank"] for r in ranked] == sorted(r["rank"] for r in ranked) and ranked[-1]["feature"] == "b"
    assert explain.spread_of_top(parts, 2).select("feature").distinct().count() == 2
    worst = explain.highest_risk(fitted, df, ["a", "b", "c"]).collect()
    assert len(worst) == 3 and len({r["employee_id"] for r in worst}) == 1
    assert worst[0]["prob"] == train.score(fitted, df).agg(F.max("prob")).first()[0]
    assert explain.dependence(parts, "a").count() == df.count()


def test_training_end_to_end(spark):
    b = Bound(spark, "/root/testdata/sf0.001")
    trained = flows.run_training(b.matrix, 1995, rounds=3, rate=0.3, leaf=2)
    row = flows.run_evaluation(trained).first().asDict()
    assert row["train_size"] + row["test_size"] == b.matrix.count() and row["n_iter"] <= 3
    tuned = flows.run_evaluation(trained, tune_on="test").first()
    assert tuned["f1_score"] >= row["f1_score"]
    assert not set(trained.columns) & set(features.NOT_FEATURES)
    results = flows.run_prediction(trained, b.matrix, b.employees)
    assert results["predictions"].filter("prob BETWEEN 0 AND 1").count() == b.matrix.count()
