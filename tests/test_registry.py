"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from rollcall.plans import registry

SMALL = Path("/root/testdata/sf0.001")
# One or two of each group; tools/compare.py runs them all.
SAMPLE = (
    "q1_2_status_split",
    "q2_9_departments_above_company",
    "k7_full_scorecard",
    "k8_risk_ranks",
    "q4_5_salary_percentile",
    "q5_4_top_learners",
    "q6_5_underpaid_performers",
    "q7_6_project_attrition",
    "v2_employee_360",
    "w1_yearly_salary_growth",
    "w3_salary_quartiles",
    "dq1_validation_report",
    "m7_scorecard",
    "t7_college_tier_curves",
    "t11_logrank_statistic",
    "t11_logrank_test",
    "h5_scored_employees",
    "n1_contributions",
    "n3_contribution_spread",
    "n4_highest_risk",
    "s12_model_file",
    "g10_feature_matrix",
    "z2_merit_cycle",
    "z3_attrition_score",
    "h4_metrics",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, str(SMALL))
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    result = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in columns]
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
    assert sorted(names) == columns and mine == theirs


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert entry_module.FLAGSHIP in entry_module.queries()
    assert registry.oracle_sql().items() <= entry_module.oracle_sql().items()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 10
