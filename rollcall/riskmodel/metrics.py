"""Threshold choice and model quality from a score column.

Input rows need ``attrition`` (0/1) and ``prob``. Everything is counted: rows
are collapsed by score, or by place on the threshold grid, before anything
else happens.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.buckets import equal_bins
from rollcall.functions.measures import percent
from rollcall.operators.ranking import running_totals

# The grid keeps its floating steps: scores are compared with these very values.
GRID = [float(x) for x in np.arange(0.05, 0.95, 0.01)]
DEFAULT_THRESHOLD = 0.5


def _grid_place(prob: Column) -> Column:
    """Number of grid values at or below ``prob``.

    A guess by division, put right by comparing with the two grid values
    around it, costs less than comparing with all of them.
    """
    grid = F.array(*[F.lit(g) for g in GRID])
    step, last = 0.01, len(GRID)
    guess = F.greatest(F.lit(1), F.least(F.floor((prob - GRID[0]) / step).cast("int"), F.lit(last - 1)))
    # guess is the 1-based place of a grid value at most one step off.
    steps = [F.when(F.element_at(grid, F.least(guess + k, F.lit(last))) <= prob, 1).otherwise(0) for k in (0, 1, 2)]
    reach = [F.when(guess + k <= last, s).otherwise(0) for k, s in zip((0, 1, 2), steps)]
    return F.when(prob < GRID[0], 0).otherwise(guess - 1 + reach[0] + reach[1] + reach[2])


def threshold_table(scored: DataFrame) -> DataFrame:
    """Confusion counts and F1 at each of the 90 grid thresholds."""
    counts = (
        scored.select("attrition", _grid_place(F.col("prob")).alias("_place"))
        .groupBy("_place")
        .agg(F.count_if(F.col("attrition") == 1).alias("_pos"), F.count_if(F.col("attrition") == 0).alias("_neg"))
    )
    # At most 91 places, so the window below has at most 91 rows.
    places = scored.sparkSession.createDataFrame(
        [(0, None), *[(i, g) for i, g in enumerate(GRID, start=1)]], "_place int, threshold double"
    )
    full = places.join(counts, "_place", "left").fillna(0, ["_pos", "_neg"])
    above = Window.orderBy(F.desc("_place")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    table = full.select(
        "threshold",
        F.sum("_pos").over(above).alias("tp"),
        F.sum("_neg").over(above).alias("fp"),
        F.sum("_pos").over(whole).alias("_p"),
        F.sum("_neg").over(whole).alias("_n"),
    ).filter("threshold IS NOT NULL")
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("_p") - tp
    f1 = F.coalesce((2 * tp).cast("double") / F.nullif((2 * tp + fp + fn).cast("double"), F.lit(0.0)), F.lit(0.0))
    return table.select("threshold", "tp", "fp", fn.alias("fn"), (F.col("_n") - fp).alias("tn"), f1.alias("f1"))


def best_threshold(scored: DataFrame) -> DataFrame:
    """The lowest threshold of the greatest F1; 0.5 where F1 is 0 everywhere."""
    best = F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), -F.col("threshold")))
    row = threshold_table(scored).agg(best.alias("b"))
    found = F.col("b.f1") > 0
    return row.select(
        F.when(found, F.round("b.threshold", 2)).otherwise(DEFAULT_THRESHOLD).alias("threshold"),
        F.col("b.f1").alias("f1"),
    )


def _by_score(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score, with both counts at or above it."""
    counts = scored.groupBy("prob").agg(
        F.count_if(F.col("attrition") == 1).alias("pos"), F.count_if(F.col("attrition") == 0).alias("neg")
    )
    return running_totals(counts, [F.desc("prob")], {"tp": "pos", "fp": "neg"})


def ranking_quality(scored: DataFrame) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision."""
    exact = "decimal(19,0)"
    twice_above = 2 * (F.col("tp") - F.col("pos")) + F.col("pos")
    pairs = F.sum(F.col("neg").cast(exact) * twice_above.cast(exact)).cast("double")
    totals = F.max("tp_all").cast("double") * F.max("fp_all").cast("double")
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    weighted = F.sum(F.col("pos") * precision)
    return _by_score(scored).agg(
        (pairs / F.nullif(2 * totals, F.lit(0.0))).alias("roc_auc"),
        (weighted / F.nullif(F.max("tp_all").cast("double"), F.lit(0.0))).alias("avg_precision"),
    )


def _confusion(df: DataFrame, threshold: Column | float) -> DataFrame:
    hit = F.col("prob") >= threshold
    yes = F.col("attrition") == 1
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(yes).alias("positives"),
        F.count_if(~yes & ~hit).alias("tn"),
        F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"),
        F.count_if(yes & hit).alias("tp"),
    )


def evaluate(
    train_scored: DataFrame,
    test_scored: DataFrame,
    threshold: float | None = None,
    tune_on: DataFrame | None = None,
) -> DataFrame:
    """One row of metrics at ``threshold``.

    Without one, the F1-best threshold on the rows ``tune_on`` is used; on the
    test rows themselves if those are not given either, which flatters F1.
    The test rows are read up to four times: pass tables that are written, not
    a scoring still to run.
    """
    if threshold is None:
        cut = best_threshold(test_scored if tune_on is None else tune_on).select("threshold").scalar()
    else:
        cut = F.lit(float(threshold))

    def part(a: Column, b: Column) -> Column:
        return F.round(F.coalesce(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0)), 4)

    fit = _confusion(train_scored, cut).select(
        part(F.col("tp") + F.col("tn"), F.col("rows")).alias("train_accuracy"),
        F.col("rows").alias("train_size"),
        percent(F.col("positives"), F.col("rows")).alias("train_attrition_rate"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    held = _confusion(test_scored, cut).select(
        cut.alias("decision_threshold"),
        part(tp + tn, F.col("rows")).alias("test_accuracy"),
        part(tp, tp + fp).alias("precision"),
        part(tp, tp + fn).alias("recall"),
        part(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "tn",
        "fp",
        "fn",
        "tp",
        F.col("rows").alias("test_size"),
        percent(F.col("positives"), F.col("rows")).alias("test_attrition_rate"),
    )
    quality = ranking_quality(test_scored).select(
        F.round("roc_auc", 4).alias("roc_auc"), F.round("avg_precision", 4).alias("avg_precision")
    )

    def beside(part: DataFrame) -> list[Column]:
        """Columns of a one-row table, as one scalar subquery."""
        row = part.select(F.struct(*part.columns).alias("r")).scalar()
        return [row.getField(c).alias(c) for c in part.columns]

    return held.select("*", *beside(fit), *beside(quality))


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct score, from (0, 0) on."""
    points = _by_score(scored)
    rate = lambda a: F.col(a).cast("double") / F.nullif(F.col(f"{a}_all").cast("double"), F.lit(0.0))
    steps = points.select(F.col("prob").alias("threshold"), rate("fp").alias("fpr"), rate("tp").alias("tpr"))
    origin = scored.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(steps)


def precision_recall_points(scored: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, ending at (1, 0); the base rate alongside."""
    points = _by_score(scored)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    base = F.col("tp_all").cast("double") / (F.col("tp_all") + F.col("fp_all"))
    steps = points.select(
        F.col("prob").alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        (tp / F.nullif(F.col("tp_all").cast("double"), F.lit(0.0))).alias("recall"),
        base.alias("base_rate"),
    )
    rate = scored.agg((F.count_if(F.col("attrition") == 1).cast("double") / F.count("*")).alias("base_rate"))
    end = rate.select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        "base_rate",
    )
    return steps.unionByName(end)


def confusion_matrix(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    predicted = (F.col("prob") >= threshold).cast("int")
    return scored.groupBy(F.col("attrition").alias("actual"), predicted.alias("predicted")).agg(
        F.count("*").alias("row_count")
    )


def score_histogram(scored: DataFrame, bins: int = 40) -> DataFrame:
    """Rows per score bin and class."""
    return (
        scored.groupBy(equal_bins(F.col("prob"), bins).alias("bin"), "attrition")
        .agg(F.count("*").alias("row_count"))
        .withColumn("bin_start", F.col("bin") / bins)
        .select("bin", "bin_start", "attrition", "row_count")
    )
