"""Curves and tests against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions import special
from rollcall.operators import survival


def spells(spark, rows):
    return spark.createDataFrame(rows, "tenure_months double, event int, college_tier string")


def brute_curve(rows):
    s, v, out = 1.0, 0.0, {0.0: (len(rows), 0, 0, 1.0)}
    for t in sorted({r[0] for r in rows}):
        n = sum(1 for r in rows if r[0] >= t)
        d = sum(1 for r in rows if r[0] == t and r[1] == 1)
        s *= 1 - d / n
        out[t] = (n, d, sum(1 for r in rows if r[0] == t and r[1] == 0), s)
    return out


def test_textbook_curve_and_median(spark):
    rows = [(1.0, 1, "a"), (2.0, 1, "a"), (2.0, 0, "a"), (3.0, 1, "a")]
    curve = survival.curves(spells(spark, rows), "college_tier").orderBy("t").collect()
    assert [(r["t"], r["survival"]) for r in curve] == [(0.0, 1.0), (1.0, 0.75), (2.0, 0.5), (3.0, 0.0)]
    summary = survival.summary(survival.curves(spells(spark, rows), "college_tier")).first()
    assert summary["median_tenure_months"] == 2.0
    # S = 0 and S = 1 have degenerate limits.
    assert (curve[3]["lower"], curve[3]["upper"]) == (0.0, 0.0)
    assert (curve[0]["lower"], curve[0]["upper"]) == (1.0, 1.0)


def test_random_curves_match_brute_force(spark):
    rng = random.Random(11)
    rows = [(float(rng.randint(1, 60)), rng.randint(0, 1), rng.choice("xyz")) for _ in range(600)]
    got = survival.curves(spells(spark, rows), "college_tier").collect()
    for cohort in "xyz":
        want = brute_curve([r for r in rows if r[2] == cohort])
        mine = {r["t"]: (r["at_risk"], r["d"], r["c"], r["survival"]) for r in got if r["cohort"] == cohort}
        assert mine.keys() == want.keys()
        for t, values in want.items():
            assert mine[t][:3] == values[:3]
            assert mine[t][3] == pytest.approx(values[3], abs=1e-12)
    for r in got:
        assert 0 <= r["lower"] <= r["survival"] <= r["upper"] <= 1


def test_without_censoring_the_curve_is_one_minus_the_ecdf(spark):
    times = [1.0, 1.0, 2.0, 5.0, 7.0]
    curve = survival.overall(spells(spark, [(t, 1, "a") for t in times])).collect()
    for r in curve:
        assert r["survival"] == pytest.approx(sum(t > r["t"] for t in times) / len(times))


def test_retention_before_the_first_step_is_one(spark):
    curve = survival.overall(spells(spark, [(40.0, 1, "a"), (50.0, 0, "a")]))
    row = survival.summary(curve).first()
    assert row["retention_36m"] == 1.0 and row["retention_48m"] == 0.5
    assert survival.summary(survival.overall(spells(spark, [(4.0, 0, "a")]))).first()["median_tenure_months"] is None


def brute_logrank(a, b):
    z = v = 0.0
    for t in sorted({r[0] for r in a + b}):
        n1, n2 = sum(r[0] >= t for r in a), sum(r[0] >= t for r in b)
        d1, d2 = sum(r[0] == t and r[1] for r in a), sum(r[0] == t and r[1] for r in b)
        n, d = n1 + n2, d1 + d2
        z += d1 - d * n1 / n
        if n > 1:
            v += d * n1 * n2 * (n - d) / (n * n * (n - 1))
    return z * z / v


def test_logrank_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(float(rng.randint(1, 30)), int(rng.random() < 0.6), rng.choice("abc")) for _ in range(300)]
    got = survival.logrank_statistics(spells(spark, rows), "college_tier").collect()
    assert sorted((r["group_1"], r["group_2"]) for r in got) == [("a", "b"), ("a", "c"), ("b", "c")]
    for r in got:
        parts = [[x for x in rows if x[2] == g] for g in (r["group_1"], r["group_2"])]
        assert r["test_stat"] == pytest.approx(brute_logrank(*parts), rel=1e-10)


def test_logrank_of_equal_groups(spark):
    half = [(1.0, 1), (2.0, 1), (3.0, 0)]
    df = spells(spark, [(t, e, g) for t, e in half for g in "ab"])
    row = survival.logrank_test(df).first()
    assert (row["test_stat"], row["p_value"], row["significant"]) == (0.0, 1.0, "No")


def test_input_censors_and_drops(spark):
    d = dt.date
    emp = spark.createDataFrame(
        [
            (1, d(2020, 1, 1), "Active", "Tier-1"),
            (2, d(2020, 1, 1), "Exited", "Tier-1"),
            (3, d(2020, 5, 5), "Exited", "Tier-2"),
        ],
        "employee_id bigint, joining_date date, status string, college_tier string",
    )
    exits = spark.createDataFrame([(2, d(2020, 7, 1)), (3, d(2020, 5, 5))], "employee_id bigint, exit_date date")
    got = {r["employee_id"]: r for r in survival.survival_input(emp, exits, d(2021, 1, 1)).collect()}
    assert set(got) == {1, 2}  # 3 left on the first day
    assert got[1]["tenure_months"] == 12.02 and got[1]["event"] == 0 and got[1]["joining_quarter"] == "2020Q1"
    assert got[2]["tenure_months"] == 5.98 and got[2]["event"] == 1


def test_cohort_filters(spark):
    rows = [(float(i % 20 + 1), i % 2, "x", 2000 + i % 3 // 2, f"d{i % 4 // 3}", f"r{i % 10}") for i in range(60)]
    df = spark.createDataFrame(
        rows, "tenure_months double, event int, college_tier string, joining_year int, department string, role string"
    )
    years = {r["cohort"] for r in survival.by_joining_year(df, 30).select("cohort").distinct().collect()}
    assert years == {"2000"}
    assert survival.by_department(df, 20).select("cohort").distinct().count() == 1
    assert survival.by_role(df, 3).select("cohort").distinct().count() == 3


def test_wide_has_null_where_a_cohort_has_no_time(spark):
    curve = survival.curves(spells(spark, [(1.0, 1, "a"), (2.0, 1, "b")]), "college_tier")
    got = {r["t"]: (r["a"], r["b"]) for r in survival.wide(curve, ["a", "b"]).collect()}
    assert got == {0.0: (1.0, 1.0), 1.0: (0.0, None), 2.0: (None, 0.0)}


def test_executive_summary_not_reached_and_ties(spark):
    df = spells(spark, [(50.0, 0, "Tier-2"), (50.0, 0, "Tier-1")])
    tiers = survival.summary(survival.by_college_tier(df))
    got = {r["metric"]: r["value"] for r in survival.executive_summary(survival.summary(survival.overall(df)), tiers).collect()}
    assert got["Median Retention (months)"] == "Not reached"
    assert got["Retention at 36 months (%)"] == "100.0"
    assert got["Best Retention College Tier"] == got["Worst Retention College Tier"] == "Tier-1"
    assert survival.tier_order(tiers).select(F.count("*")).first()[0] == 2


def test_erfc_equals_the_library(spark):
    values = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.9999, 2.0, 2.0001, 3.0, 5.5, 12.0, 26.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "z double")
    got = [r[0] for r in df.select(special.erfc(F.col("z"))).collect()]
    assert got[-1] is None
    assert all(g == pytest.approx(math.erfc(v), rel=1e-9, abs=1e-15) for g, v in zip(got, values))
    tails = df.where("z IS NOT NULL").select(special.chi2_tail(F.col("z"))).collect()
    assert [r[0] for r in tails] == pytest.approx([math.erfc(math.sqrt(v / 2)) for v in values], rel=1e-9, abs=1e-15)


def test_logrank_of_many_cohorts(spark):
    """All pairs of 200 cohorts; three of them against brute force."""
    rng = random.Random(12)
    rows = [(rng.randint(1, 40) / 2, int(rng.random() < 0.5), f"g{i % 200:03d}") for i in range(4000)]
    got = {(r["group_1"], r["group_2"]): r["test_stat"] for r in survival.logrank_statistics(spells(spark, rows), "college_tier").collect()}
    assert len(got) == 200 * 199 // 2
    for a, b in (("g000", "g001"), ("g007", "g199"), ("g100", "g150")):
        parts = [[r for r in rows if r[2] == x] for x in (a, b)]
        assert got[a, b] == pytest.approx(brute_logrank(*parts), rel=1e-9)
    some = survival.logrank_statistics(spells(spark, rows), "college_tier", ["g003", "g001", "g002"]).collect()
    assert {(r["group_1"], r["group_2"]) for r in some} == {("g001", "g002"), ("g001", "g003"), ("g002", "g003")}


def test_cohorts_without_events_have_no_statistic(spark):
    rows = [(1.0, 0, "a"), (2.0, 0, "b"), (1.0, 1, "c")]
    got = {(r["group_1"], r["group_2"]): r["test_stat"] for r in survival.logrank_statistics(spells(spark, rows), "college_tier").collect()}
    assert got.keys() == {("a", "b"), ("a", "c"), ("b", "c")} and got["a", "b"] is None
