"""The workforce tables and rounding rules as plain SQL.

Every registered query that SQL can express is checked against SQL written
with these helpers. Rounding is done on whole numbers, so it does not depend on
how an engine rounds binary fractions.
"""

from __future__ import annotations

import re

from rollcall.sources.star import LEVEL_EDGES, MANAGER_DEPARTMENTS, REASONS, TEST_BANDS

AS_OF = "DATE '2001-08-02'"
CUTOFF = "DATE '2000-08-01'"


def _case(value: str, labels: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels[:-1]))
    return f"CASE {value} % {len(labels)} {arms} ELSE '{labels[-1]}' END"


def _manager(number: str) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'MGR' || lpad({text}, CAST(greatest(4, length({text})) AS INT), '0')"


_LEVEL = "CASE " + " ".join(f"WHEN c_acctbal < {e} THEN '{lv}'" for e, lv in LEVEL_EDGES) + " ELSE 'L5' END"

_STAFF = f"""
SELECT c_custkey AS employee_id,
 CASE WHEN c_custkey % 100 = 99 THEN 'Non-binary' WHEN c_custkey % 5 < 3 THEN 'Male' ELSE 'Female' END AS gender,
 21 + c_custkey % 40 AS age, n_name AS location, c_mktsegment AS department,
 c_mktsegment || ' ' || {_LEVEL} AS role, {_LEVEL} AS level, first_d AS joining_date,
 'Tier-' || CAST(1 + c_nationkey % 3 AS VARCHAR) AS college_tier,
 CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE {_manager("((c_custkey + 7 * c_nationkey) % n_sup)")} END AS manager_id,
 CASE WHEN last_d < {CUTOFF} THEN 'Exited' ELSE 'Active' END AS status, last_d AS last_date
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_d, CAST(max(o_orderdate) AS DATE) AS last_d
      FROM orders GROUP BY o_custkey) spans ON o_custkey = c_custkey
CROSS JOIN (SELECT count(*) AS n_sup FROM supplier) s"""

_LINES = """
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

TABLES = {
    "staff": _STAFF,
    "employees": "SELECT * EXCLUDE (last_date) FROM staff",
    "managers": f"""
SELECT {_manager("s_suppkey")} AS manager_id, {_case("s_suppkey", MANAGER_DEPARTMENTS)} AS department,
 n_name AS location, 8 + s_suppkey % 15 AS experience_years
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "compensation": """
SELECT o_orderkey AS comp_id, employee_id, CAST(o_orderdate AS DATE) AS effective_date, level,
 CAST(o_totalprice AS DECIMAL(12,2)) AS salary, CAST(o_orderkey % 20000 AS DECIMAL(12,2)) AS bonus,
 CAST(CASE WHEN level IN ('L4', 'L5') THEN o_orderkey % 5000 ELSE 0 END AS DECIMAL(12,2)) AS stock
FROM orders JOIN staff ON o_custkey = employee_id""",
    "performance": """
SELECT o_orderkey AS rating_id, o_custkey AS employee_id, year(o_orderdate) AS review_year,
 CAST(substr(o_orderpriority, 1, 1) AS INT) AS rating,
 CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS promotion
FROM orders""",
    "projects": f"""
SELECT o_custkey AS employee_id, p_brand AS project_name,
 'Client ' || CAST(l_suppkey % 10 AS VARCHAR) AS client_name, CAST(o_orderdate AS DATE) AS start_date,
 CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS end_date,
 l_linestatus = 'O' AS billable {_LINES}""",
    "learning": f"""
SELECT o_custkey AS employee_id, p_name AS course_name, p_type AS skill_category, l_quantity AS hours_completed,
 CASE WHEN l_linestatus = 'F' THEN 'Completed' ELSE 'In Progress' END AS completion_status,
 CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS completion_date {_LINES}""",
    "exits": f"""
SELECT employee_id, last_date AS exit_date, {_case("employee_id", REASONS)} AS exit_reason,
 employee_id % 7 <> 4 AS voluntary
FROM staff WHERE status = 'Exited'""",
    "bands": "SELECT * FROM (VALUES "
    + ", ".join(f"('{lv}', {lo}, {hi})" for lv, (lo, hi) in TEST_BANDS.items())
    + ") b(level, band_min, band_max)",
}
_NEEDS = {"employees": ["staff"], "compensation": ["staff"], "exits": ["staff"]}


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the tables it mentions; ``extra`` adds named queries of its own."""
    extra = extra or {}
    available = {**TABLES, **extra}
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in available.items():
            if name not in wanted and re.search(rf"\b(FROM|JOIN)\s+\(?{name}\b", text):
                wanted.add(name)
                visit(sql)

    visit(body)
    parts = ", ".join(f"{name} AS ({available[name]})" for name in available if name in wanted)
    if not parts:
        return body
    # Named queries of the body come after the tables they read.
    return f"WITH {parts}, {body[5:]}" if body.startswith("WITH ") else f"WITH {parts} {body}"


def half_up(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """scale * num / den rounded half away from zero; num and den are whole, den positive."""
    k = scale * 10**digits
    size = f"((2 * abs({num}) * {k} + ({den})) // (2 * ({den})))"
    return f"CAST(sign({num}) * {size} AS DOUBLE) / {10**digits}"


def half_even(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """As :func:`half_up`, with ties to the even digit."""
    k = scale * 10**digits
    a, b = f"(2 * abs({num}) * {k} + ({den}))", f"(2 * ({den}))"
    size = f"(CASE WHEN {a} % {b} = 0 AND ({a} // {b}) % 2 = 1 THEN {a} // {b} - 1 ELSE {a} // {b} END)"
    return f"CAST(sign({num}) * {size} AS DOUBLE) / {10**digits}"


def where(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def rate(cond: str, digits: int = 2, rounding=half_up) -> str:
    return rounding(where(cond), "count(*)", digits, 100)


def mean_int(col: str, digits: int = 2, rounding=half_up) -> str:
    """Mean of a whole-number column."""
    return rounding(f"CAST(sum({col}) AS HUGEINT)", f"count({col})", digits)


def mean_money(col: str, digits: int = 0, rounding=half_up) -> str:
    """Mean of a two-digit decimal column."""
    return rounding(f"CAST(sum({col}) * 100 AS HUGEINT)", f"(100 * count({col}))", digits)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def years(later: str, earlier: str) -> str:
    return f"extract(YEAR FROM age(CAST({later} AS TIMESTAMP), CAST({earlier} AS TIMESTAMP)))"


def tenure(end: str, start: str) -> str:
    """Days over 30.44 at two digits; no number of days is a tie."""
    return half_up(f"(({end}) - ({start})) * 100", "3044")


LATEST = """
SELECT * FROM compensation
QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY effective_date DESC, comp_id DESC) = 1"""


def share(group: str, name: str, table: str, out: str = "percentage", more: str = "") -> str:
    """Group sizes of ``table`` with their share in all rows."""
    total = "CAST(sum(count(*)) OVER () AS HUGEINT)"
    return (
        f"SELECT {group}, count(*) AS {name}{more}, {half_up('count(*)', total, 2, 100)} AS {out} "
        f"FROM {table} GROUP BY {group}"
    )
