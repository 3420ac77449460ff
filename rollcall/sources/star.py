"""Workforce tables over a star schema of customers, orders and line items.

Customers are employees, suppliers managers, orders pay and review history,
line items projects and courses; a customer silent for a year has left. The
same rules are written as SQL in ``rollcall.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2001, 8, 2)
EXIT_CUTOFF = dt.date(2000, 8, 1)
TRAIN_CUTOFF = 1995
# Bands that make all three band results occur on the test data.
TEST_BANDS = {
    "L1": (1000, 300000),
    "L2": (50000, 350000),
    "L3": (100000, 400000),
    "L4": (150000, 450000),
    "L5": (200000, 500000),
}
LEVEL_EDGES = ((1200, "L1"), (3400, "L2"), (5600, "L3"), (7800, "L4"))
REASONS = (
    "Better Opportunity",
    "Career Growth",
    "Personal Reasons",
    "Compensation",
    "Performance Issues",
    "Relocation",
    "Higher Education",
)
MANAGER_DEPARTMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# Difficulty of the test projects; the others count as Medium.
TEST_DIFFICULTY = {f"Brand#{n}": ("High" if n <= 8 else "Low") for n in (*range(1, 9), *range(18, 26))}


@dataclass(frozen=True)
class Workforce:
    """The seven tables and the date they are looked at."""

    employees: DataFrame
    managers: DataFrame
    compensation: DataFrame
    performance: DataFrame
    projects: DataFrame
    learning: DataFrame
    exits: DataFrame
    as_of: dt.date = AS_OF

    def tables(self) -> dict[str, DataFrame]:
        names = ("employees", "managers", "compensation", "performance", "projects", "learning", "exits")
        return {name: getattr(self, name) for name in names}


def _pick(key: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _manager_id(number: Column) -> Column:
    text = number.cast("string")
    return F.concat(F.lit("MGR"), F.lpad(text, F.greatest(F.lit(4), F.length(text)), F.lit("0")))


def _level(balance: Column) -> Column:
    chain = None
    for edge, label in LEVEL_EDGES:
        chain = F.when(balance < edge, label) if chain is None else chain.when(balance < edge, label)
    return chain.otherwise("L5")


def bind(spark: SparkSession, directory: str, as_of: dt.date = AS_OF) -> Workforce:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")

    customer, nation, supplier = read("customer"), read("nation"), read("supplier")
    orders, lineitem, part = read("orders"), read("lineitem"), read("part")

    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_nationkey").alias("nation"),
        F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("department"),
        _level(F.col("c_acctbal")).alias("level"),
    )
    spans = orders.groupBy(F.col("o_custkey").alias("employee_id")).agg(
        F.min("o_orderdate").cast("date").alias("joining_date"),
        F.max("o_orderdate").cast("date").alias("last_date"),
    )
    n_suppliers = supplier.agg(F.count("*").alias("n")).scalar()
    key = F.col("employee_id")
    staff = people.join(spans, "employee_id").select(
        key,
        F.when(key % 100 == 99, "Non-binary").when(key % 5 < 3, "Male").otherwise("Female").alias("gender"),
        (21 + key % 40).cast("int").alias("age"),
        "location",
        "department",
        F.concat_ws(" ", "department", "level").alias("role"),
        "level",
        "joining_date",
        F.concat(F.lit("Tier-"), (1 + F.col("nation") % 3).cast("string")).alias("college_tier"),
        F.when(key % 50 != 0, _manager_id((key + 7 * F.col("nation")) % n_suppliers)).alias("manager_id"),
        F.when(F.col("last_date") < F.lit(EXIT_CUTOFF), "Exited").otherwise("Active").alias("status"),
        "last_date",
    )
    managers = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _manager_id(F.col("s_suppkey")).alias("manager_id"),
        _pick(F.col("s_suppkey"), MANAGER_DEPARTMENTS).alias("department"),
        F.col("n_name").alias("location"),
        (8 + F.col("s_suppkey") % 15).cast("int").alias("experience_years"),
    )
    money = "decimal(12,2)"
    # Every employee has an order, so the pay level can come from the customer alone.
    compensation = orders.join(
        people.select("employee_id", "level"), F.col("o_custkey") == F.col("employee_id")
    ).select(
        F.col("o_orderkey").alias("comp_id"),
        "employee_id",
        F.col("o_orderdate").cast("date").alias("effective_date"),
        "level",
        F.col("o_totalprice").cast(money).alias("salary"),
        (F.col("o_orderkey") % 20000).cast(money).alias("bonus"),
        F.when(F.col("level").isin("L4", "L5"), F.col("o_orderkey") % 5000).otherwise(0).cast(money).alias("stock"),
    )
    performance = orders.select(
        F.col("o_orderkey").alias("rating_id"),
        F.col("o_custkey").alias("employee_id"),
        F.year("o_orderdate").alias("review_year"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("promotion"),
    )
    lines = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    shipped = F.col("l_shipdate").cast("date")
    projects = lines.select(
        F.col("o_custkey").alias("employee_id"),
        F.col("p_brand").alias("project_name"),
        F.concat(F.lit("Client "), (F.col("l_suppkey") % 10).cast("string")).alias("client_name"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.when(F.col("l_returnflag") != "N", shipped).alias("end_date"),
        (F.col("l_linestatus") == "O").alias("billable"),
    )
    done = F.col("l_linestatus") == "F"
    learning = lines.select(
        F.col("o_custkey").alias("employee_id"),
        F.col("p_name").alias("course_name"),
        F.col("p_type").alias("skill_category"),
        F.col("l_quantity").alias("hours_completed"),
        F.when(done, "Completed").otherwise("In Progress").alias("completion_status"),
        F.when(done, shipped).alias("completion_date"),
    )
    exits = staff.filter(F.col("status") == "Exited").select(
        "employee_id",
        F.col("last_date").alias("exit_date"),
        _pick(key, REASONS).alias("exit_reason"),
        (key % 7 != 4).alias("voluntary"),
    )
    return Workforce(
        staff.drop("last_date"), managers, compensation, performance, projects, learning, exits, as_of
    )
