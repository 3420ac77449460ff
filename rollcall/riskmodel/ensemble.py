"""An ensemble as a table, scored and explained by joins and aggregates.

One row per leaf and condition: tree, leaf, value, feature, low, high, share. A
row of the feature matrix meets a condition when its value is above ``low`` and
at most ``high``; it reaches the leaf all of whose conditions it meets; ``share``
is the part of the training rows that meet the condition where it is asked.
The table's size depends on the number of trees and their depth only.

Every row meets every condition on its features in these joins, so they are
made for scorecards of some dozens of leaves, and for checking; a large
ensemble is scored tree by tree in ``train.score``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.kernels import Leaf
from rollcall.riskmodel.explain import tree_leaves
from rollcall.riskmodel.train import Ensemble

SCHEMA = "tree int, leaf int, value double, feature string, low double, high double, share double"
# Places and weights with which a polynomial of degree 7 or less is integrated from 0 to 1 exactly (Gauss-Legendre, 4 points).
PLACES = (0.06943184420297371, 0.33000947820757187, 0.6699905217924281, 0.9305681557970262)
WEIGHTS = (0.17392742256872692, 0.32607257743127307, 0.32607257743127307, 0.17392742256872692)
# So a leaf may have eight conditions: seven beside the one looked at.
MOST_CONDITIONS = 8


def leaf_rows(leaves: Sequence[Leaf], features: Sequence[str], tree: int) -> list[tuple]:
    """Table rows of one tree's leaves; a leaf without conditions has one row without a feature."""
    rows: list[tuple] = []
    for i, (value, conditions) in enumerate(leaves):
        rows += [(tree, i, value, features[f], low, high, share) for f, low, high, share in conditions] or [
            (tree, i, value, None, None, None, None)
        ]
    return rows


def as_table(spark: SparkSession, model: Ensemble) -> DataFrame:
    """The trees of a fitted model."""
    rows = [r for i, tree in enumerate(model.trees) for r in leaf_rows(list(tree_leaves(tree)), model.features, i)]
    return spark.createDataFrame(rows, SCHEMA)


def long_rows(matrix: DataFrame, features: Sequence[str], key: str = "employee_id") -> DataFrame:
    """One row per row of ``matrix`` and feature: key, feature, value."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value")) for f in features]
    return matrix.select(key, F.inline(F.array(*cells)))


def _used(matrix: DataFrame, table: DataFrame) -> list[str]:
    """Features the table asks for; bounded by its size."""
    asked = {r[0] for r in table.select("feature").distinct().collect()}
    return [c for c in matrix.columns if c in asked]


def _met() -> Column:
    return F.coalesce((F.col("value") > F.col("low")) & (F.col("value") <= F.col("high")), F.lit(False))


def margins(matrix: DataFrame, table: DataFrame, base: float, key: str = "employee_id") -> DataFrame:
    """(key, margin): the base and the values of all leaves a row reaches.

    An interval join finds the conditions met; a leaf is reached when all of its
    conditions are. A NULL value meets none. ``key`` is unique in ``matrix``.
    """
    sized = table.groupBy("tree", "leaf").agg(F.count("feature").alias("asked"), F.first("value").alias("add"))
    always = sized.where("asked = 0").agg(F.coalesce(F.sum("add"), F.lit(0.0))).first()[0]
    asked = table.where("feature IS NOT NULL").withColumnRenamed("value", "leaf_value")
    # The table has a fixed size, whatever the number of rows scored.
    hits = long_rows(matrix, _used(matrix, table), key).join(F.broadcast(asked), "feature")
    reached = (
        hits.where(_met())
        .groupBy(key, "tree", "leaf")
        .agg(F.count("*").alias("met"))
        .join(F.broadcast(sized.where("asked > 0")), ["tree", "leaf"])
        .where("met = asked")
    )
    sums = reached.groupBy(key).agg(F.sum("add").alias("sum"))
    return matrix.select(key).join(sums, key, "left").select(key, (F.coalesce("sum", F.lit(0.0)) + (base + always)).alias("margin"))


def score(matrix: DataFrame, table: DataFrame, base: float, threshold: float = 0.5, key: str = "employee_id") -> DataFrame:
    """``matrix`` with ``prob`` and ``predicted_attrition``."""
    scored = matrix.join(margins(matrix, table, base, key), key).withColumn("prob", 1 / (1 + F.exp(-F.col("margin"))))
    return scored.drop("margin").withColumn("predicted_attrition", (F.col("prob") >= threshold).cast("int"))


def _times(t: float) -> Callable[[Column, Column], Column]:
    return lambda acc, o: acc * (o["met"] * t + o["share"] * (1 - t))


def contributions(matrix: DataFrame, table: DataFrame, key: str = "employee_id") -> DataFrame:
    """Shapley values of the log-odds: key, feature, value, contribution, for the features the table asks for.

    Knowing a feature makes its condition 0 or 1, not knowing it leaves its share.
    Over all orders in which features become known, a condition's part is the
    integral over t of (met - share) times the product of t * met + (1 - t) *
    share over the leaf's other conditions: a polynomial, integrated exactly.
    """
    widest = table.groupBy("tree", "leaf").agg(F.count("feature").alias("n")).agg(F.max("n")).first()[0]
    if (widest or 0) > MOST_CONDITIONS:
        raise ValueError(f"a leaf has more than {MOST_CONDITIONS} conditions")
    long = long_rows(matrix, _used(matrix, table), key)
    asked = table.where("feature IS NOT NULL").withColumnRenamed("value", "leaf_value")
    flagged = long.join(F.broadcast(asked), "feature").select(
        key, "tree", "leaf", "leaf_value", F.struct("feature", _met().cast("double").alias("met"), "share").alias("c")
    )
    # At most as many conditions as the tree is deep.
    paths = flagged.groupBy(key, "tree", "leaf").agg(F.first("leaf_value").alias("leaf_value"), F.collect_list("c").alias("cs"))

    def part(c: Column, i: Column) -> Column:
        others = F.filter("cs", lambda _, j: j != i)
        total = F.lit(0.0)
        for t, w in zip(PLACES, WEIGHTS, strict=True):
            total = total + F.aggregate(others, F.lit(1.0), _times(t)) * w
        return F.struct(c["feature"].alias("feature"), (F.col("leaf_value") * (c["met"] - c["share"]) * total).alias("part"))

    parts = paths.select(key, F.inline(F.transform("cs", part)))
    sums = parts.groupBy(key, "feature").agg(F.sum("part").alias("contribution"))
    return long.join(sums, [key, "feature"], "left").select(key, "feature", "value", F.coalesce("contribution", F.lit(0.0)).alias("contribution"))


def base_value(table: DataFrame, base: float) -> float:
    """Expected log-odds when no feature is known."""
    share = F.aggregate(F.collect_list("share"), F.lit(1.0), lambda acc, s: acc * s)
    leaves = table.groupBy("tree", "leaf").agg(F.first("value").alias("value"), share.alias("share"))
    return base + (leaves.agg(F.sum(F.col("value") * F.col("share"))).first()[0] or 0.0)
