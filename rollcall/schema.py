"""Fixed table schemas and rule tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()

# Column order, types and nullability of the seven tables.
TABLES: dict[str, T.StructType] = {
    "managers": _struct(
        ("manager_id", _S, False),
        ("department", _S, False),
        ("location", _S, False),
        ("team_size", _I, False),
        ("experience_years", _I, False),
    ),
    "employees": _struct(
        ("employee_id", _L, False),
        ("gender", _S, False),
        ("age", _I, False),
        ("location", _S, False),
        ("department", _S, False),
        ("role", _S, False),
        ("level", _S, False),
        ("joining_date", _D, False),
        ("college_tier", _S, False),
        ("manager_id", _S, True),
        ("status", _S, False),
    ),
    "compensation": _struct(
        ("comp_id", _L, False),
        ("employee_id", _L, False),
        ("effective_date", _D, False),
        ("level", _S, False),
        ("salary", MONEY, False),
        ("bonus", MONEY, False),
        ("stock", MONEY, False),
    ),
    "projects": _struct(
        ("assignment_id", _L, False),
        ("employee_id", _L, False),
        ("project_name", _S, False),
        ("client_name", _S, False),
        ("start_date", _D, False),
        ("end_date", _D, True),
        ("billable", T.BooleanType(), False),
    ),
    "performance": _struct(
        ("rating_id", _L, False),
        ("employee_id", _L, False),
        ("review_year", _I, False),
        ("rating", _I, False),
        ("promotion", _S, False),
    ),
    "learning": _struct(
        ("learning_id", _L, False),
        ("employee_id", _L, False),
        ("course_name", _S, False),
        ("skill_category", _S, False),
        ("hours_completed", T.DoubleType(), False),
        ("completion_status", _S, False),
        ("completion_date", _D, True),
    ),
    "exits": _struct(
        ("exit_id", _L, False),
        ("employee_id", _L, False),
        ("exit_date", _D, False),
        ("exit_reason", _S, False),
        ("voluntary", T.BooleanType(), False),
    ),
}

# Serial keys a database would assign on load; absent from the CSV files.
SERIALS = {
    "compensation": "comp_id",
    "projects": "assignment_id",
    "performance": "rating_id",
    "learning": "learning_id",
    "exits": "exit_id",
}

# File stem of each table in a CSV data directory.
FILES = {
    "employees": "employees",
    "managers": "managers",
    "compensation": "compensation",
    "performance": "performance",
    "projects": "project_assignments",
    "learning": "learning",
    "exits": "exit_records",
}

# The six tables validation and feature building need (managers is optional).
REQUIRED = ("employees", "compensation", "performance", "projects", "learning", "exits")

# --- Fixed values: levels, bands, promotion rules, hikes and bonuses ---------
LEVELS = ("L1", "L2", "L3", "L4", "L5")
SALARY_BANDS = {
    "L1": (370000, 550000),
    "L2": (600000, 950000),
    "L3": (1000000, 1500000),
    "L4": (1600000, 2400000),
    "L5": (2500000, 4500000),
}
# level -> (next level, years in level, mean rating, learning hours)
PROMOTION_RULES = {
    "L1": ("L2", 2, Decimal("4.0"), 40),
    "L2": ("L3", 3, Decimal("4.0"), 60),
    "L3": ("L4", 4, Decimal("4.2"), 80),
    "L4": ("L5", 5, Decimal("4.3"), 100),
}
# rating -> fraction of salary
HIKES = {
    1: Decimal("0.00"),
    2: Decimal("0.04"),
    3: Decimal("0.08"),
    4: Decimal("0.12"),
    5: Decimal("0.16"),
}
BONUSES = {
    1: Decimal("0.00"),
    2: Decimal("0.03"),
    3: Decimal("0.05"),
    4: Decimal("0.08"),
    5: Decimal("0.12"),
}
# Difficulty of each catalogued project; any other project counts as Medium.
PROJECT_DIFFICULTY = {
    "Apollo Core": "High",
    "Phoenix Rewrite": "Medium",
    "Orion API": "High",
    "DataHub Predictive": "High",
    "Retail Analytics": "Medium",
    "AI Recommendation Engine": "High",
    "CloudMigrate v2": "High",
    "Kubernetes Migration": "Medium",
    "DevOps Automation": "Medium",
    "Sentinel Security": "High",
    "Penetration Testing": "High",
    "Vulnerability Patcher": "Medium",
    "Recruitment Automation": "Low",
    "Ledger Reconciliation": "Medium",
    "Tax Calculator Portal": "Low",
    "CRM Integration": "Medium",
    "Global Account Pitching": "High",
    "SEO & Content Campaign": "Low",
    "Digital Brand Relaunch": "Medium",
    "SLA Helpdesk Migration": "Medium",
    "Desktop Automation Support": "Low",
}
# -----------------------------------------------------------------------------


def bands_frame(spark: SparkSession, bands: dict | None = None) -> DataFrame:
    """Salary bands as a table of one row per level."""
    rows = [(lv, Decimal(lo), Decimal(hi)) for lv, (lo, hi) in (bands or SALARY_BANDS).items()]
    return spark.createDataFrame(
        rows, _struct(("level", _S, False), ("band_min", MONEY, False), ("band_max", MONEY, False))
    )


def promotion_rules_frame(spark: SparkSession, rules: dict | None = None) -> DataFrame:
    """Promotion thresholds as a table of one row per level below the top."""
    rows = [(lv, *rule) for lv, rule in (rules or PROMOTION_RULES).items()]
    return spark.createDataFrame(
        rows,
        _struct(
            ("level", _S, False),
            ("next_level", _S, False),
            ("min_years", _I, False),
            ("min_avg_rating", T.DecimalType(3, 1), False),
            ("min_learning_hours", _I, False),
        ),
    )


def merit_frame(spark: SparkSession, hikes: dict | None = None, bonuses: dict | None = None) -> DataFrame:
    """Hike and bonus fractions as a table of one row per rating."""
    hikes, bonuses = hikes or HIKES, bonuses or BONUSES
    fraction = T.DecimalType(4, 2)
    return spark.createDataFrame(
        [(r, hikes[r], bonuses[r]) for r in hikes],
        _struct(("rating", _I, False), ("hike", fraction, False), ("bonus_rate", fraction, False)),
    )
