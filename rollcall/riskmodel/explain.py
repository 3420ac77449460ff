"""Exact feature contributions of the boosted trees.

A leaf is reached under a handful of conditions, each on one feature. Knowing a
feature makes its condition 0 or 1; not knowing it leaves the share of training
rows that meet it. The Shapley value of such a product is a short sum, so
contributions need no sampling and add up to the score of every row. Spark
hands out the rows; a small numpy helper works on each Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.boosting import Tree
from rollcall.functions.kernels import Leaf, leaf_contributions
from rollcall.operators.ranking import average_ranks, top
from rollcall.riskmodel.train import Ensemble, score


def tree_leaves(tree: Tree, node: int = 0, path: dict[int, tuple[float, float, float]] | None = None) -> Iterator[Leaf]:
    """Leaves below ``node``: value and (feature, low, high, share) per feature on the path."""
    path = path or {}
    feature = int(tree.feature[node])
    if feature < 0:
        yield float(tree.value[node]), [(f, *bounds) for f, bounds in path.items()]
        return
    cut, here = float(tree.cut[node]), int(tree.rows[node])
    low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
    for child, bounds in ((2 * node + 1, (low, min(high, cut))), (2 * node + 2, (max(low, cut), high))):
        yield from tree_leaves(tree, child, {**path, feature: (*bounds, share * (int(tree.rows[child]) / here))})


def model_leaves(model: Ensemble) -> list[Leaf]:
    """All leaves of the ensemble; their number depends on rounds and depth only."""
    return [leaf for tree in model.trees for leaf in tree_leaves(tree)]


def base_value(model: Ensemble) -> float:
    """Expected log-odds when no feature is known."""
    leaves = model_leaves(model)
    return model.base + float(sum(value * np.prod([c[3] for c in conditions]) for value, conditions in leaves))


def contributions(model: Ensemble, matrix: DataFrame, features: list[str]) -> DataFrame:
    """Contribution of every feature to the log-odds of every row.

    One row per employee and feature: employee_id, feature, value, contribution.
    """
    leaves = model_leaves(model)
    width = len(features)

    def batch(vectors: pd.Series) -> pd.Series:
        return leaf_contributions(vectors, leaves, width)

    explain = F.pandas_udf(batch, T.ArrayType(T.DoubleType()))
    vectors = matrix.select("employee_id", F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("_x"))
    explained = vectors.withColumn("_phi", explain("_x"))
    names = F.array(*[F.lit(f) for f in features])
    cells = F.arrays_zip(names.alias("feature"), F.col("_x").alias("value"), F.col("_phi").alias("contribution"))
    return explained.select("employee_id", F.inline(cells).alias("feature", "value", "contribution"))


def importance(parts: DataFrame, n: int | None = None) -> DataFrame:
    """Mean absolute contribution of each feature, ranked; ties share their rank."""
    means = parts.groupBy("feature").agg(F.round(F.avg(F.abs("contribution")), 6).alias("mean_abs_contribution"))
    ranked = average_ranks(means, "mean_abs_contribution", descending=True).withColumn("rank", F.col("rank").cast("int"))
    ordered = ranked.select("feature", "mean_abs_contribution", "rank")
    return top(ordered, n, "rank", "feature") if n else ordered.orderBy("rank", "feature")


def spread_of_top(parts: DataFrame, n: int = 15) -> DataFrame:
    """All contributions to the ``n`` most important features."""
    leading = importance(parts, n).select("feature", "rank")
    # n rows.
    return parts.join(F.broadcast(leading), "feature").select("rank", "feature", "employee_id", "value", "contribution")


def highest_risk(model: Ensemble, matrix: DataFrame, features: list[str]) -> DataFrame:
    """Explanation of the row with the highest score, largest contribution first."""
    scored = score(model, matrix)
    worst = top(scored, 1, F.desc("prob"), "employee_id")
    return waterfall(contributions(model, worst.drop("prob", "predicted_attrition"), features), worst, base_value(model))


def waterfall(parts: DataFrame, worst: DataFrame, base: float) -> DataFrame:
    """The contributions of one scored row beside its score and the base value, largest first."""
    return (
        parts.join(worst.select("employee_id", "prob"), "employee_id")
        .withColumn("base_value", F.lit(base))
        .orderBy(F.desc(F.abs("contribution")), "feature")
    )


def dependence(parts: DataFrame, feature: str = "tenure_months") -> DataFrame:
    """Value against contribution for one feature."""
    return parts.filter(F.col("feature") == feature).select("employee_id", "value", "contribution")
