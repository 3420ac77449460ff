"""Kaplan-Meier retention curves and log-rank tests.

Staff are counted per (cohort, tenure) first. Tenure is a number of days, so
whatever follows works on some ten thousand rows per cohort at most, and all
cohorts of an analysis share one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.dates import day, quarter_label, tenure_months
from rollcall.functions.measures import is_exited
from rollcall.functions.special import chi2_tail
from rollcall.operators.ranking import top

# Retention is reported at these months.
HORIZONS = (12, 24, 36, 48, 60)
Z_95 = 1.959963984540054


def survival_input(employees: DataFrame, exits: DataFrame, as_of: dt.date) -> DataFrame:
    """Tenure and event flag of every employee; active staff are censored at ``as_of``."""
    left = exits.select("employee_id", "exit_date")
    end = F.coalesce(F.col("exit_date"), day(as_of))
    return (
        employees.join(left, "employee_id", "left")
        .withColumn("end_date", end)
        .withColumn("tenure_months", tenure_months(F.col("end_date"), F.col("joining_date")))
        .filter("tenure_months > 0")
        .withColumn("event", is_exited().cast("int"))
        .withColumn("joining_quarter", quarter_label(F.col("joining_date")))
        .withColumn("joining_year", F.year("joining_date"))
    )


def _counts(df: DataFrame, cohort: Column) -> DataFrame:
    """Events d and censored c per cohort and tenure t."""
    return df.groupBy(cohort.cast("string").alias("cohort"), F.col("tenure_months").alias("t")).agg(
        F.count_if(F.col("event") == 1).alias("d"), F.count_if(F.col("event") != 1).alias("c")
    )


def curves(df: DataFrame, cohort: str | Column) -> DataFrame:
    """Product-limit curve of every cohort with 95% log-log limits.

    Rows: cohort, t, at_risk, d, c, survival, lower, upper; a row at t = 0
    starts each curve.
    """
    cohort = F.col(cohort) if isinstance(cohort, str) else cohort
    counts = _counts(df.filter(cohort.isNotNull()), cohort)
    up = Window.partitionBy("cohort").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("cohort").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    risk = counts.withColumn("at_risk", F.sum(F.col("d") + F.col("c")).over(down))
    n, d = F.col("at_risk"), F.col("d")
    steps = risk.select(
        "cohort",
        "t",
        "at_risk",
        "d",
        "c",
        # A product keeps an exact 0, where a sum of logarithms would be NULL.
        F.product(1 - d / n).over(up).alias("survival"),
        F.sum(F.when(n > d, d / (n.cast("double") * (n - d)))).over(up).alias("_v"),
    )
    start = counts.groupBy("cohort").agg(F.sum(F.col("d") + F.col("c")).alias("at_risk"))
    zero = F.lit(0).cast("bigint")
    origin = start.select(
        "cohort",
        F.lit(0.0).alias("t"),
        "at_risk",
        zero.alias("d"),
        zero.alias("c"),
        F.lit(1.0).alias("survival"),
        F.lit(0.0).alias("_v"),
    )
    s = F.col("survival")
    inside = (s > 0) & (s < 1)

    def limit(sign: int) -> Column:
        power = F.exp(F.lit(sign * Z_95) * F.sqrt("_v") / F.ln(F.when(inside, s)))
        return F.when(inside, F.pow(s, power)).otherwise(s)

    # ln S is negative, so the positive sign gives the upper limit.
    return origin.unionByName(steps).select(
        "cohort", "t", "at_risk", "d", "c", "survival", limit(-1).alias("lower"), limit(1).alias("upper")
    )


def confidence_band(curve: DataFrame) -> DataFrame:
    return curve.select("cohort", "t", "survival", "lower", "upper")


def retention_at(curve: DataFrame, month: float, name: str = "retention") -> DataFrame:
    """S at ``month`` for each cohort; 1 before the first step."""
    return curve.groupBy("cohort").agg(_at(month).alias(name))


def _at(month: float) -> Column:
    survived = F.max_by("survival", F.when(F.col("t") <= month, F.col("t")))
    return F.round(F.coalesce(survived, F.lit(1.0)), 4)


def summary(curve: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Median tenure and S at each horizon, per cohort.

    The median is the first t with S <= 0.5, NULL where S never gets there.
    """
    return curve.groupBy("cohort").agg(
        F.min(F.when(F.col("survival") <= 0.5, F.col("t"))).alias("median_tenure_months"),
        *[_at(m).alias(f"retention_{m}m") for m in horizons],
    )


def overall(df: DataFrame) -> DataFrame:
    return curves(df, F.lit("Overall"))


def by_college_tier(df: DataFrame) -> DataFrame:
    return curves(df, "college_tier")


def _large(df: DataFrame, key: str, least: int) -> DataFrame:
    """Rows of the cohorts with at least ``least`` members."""
    sizes = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    return df.join(sizes.select(key), key, "left_semi")


def by_role(df: DataFrame, top_n: int = 8) -> DataFrame:
    """The ``top_n`` largest roles; ties go by name."""
    sizes = df.filter(F.col("role").isNotNull()).groupBy("role").agg(F.count("*").alias("_n"))
    largest = top(sizes, top_n, F.desc("_n"), "role").select("role")
    return curves(df.join(largest, "role", "left_semi"), "role")


def by_joining_year(df: DataFrame, least: int = 30) -> DataFrame:
    return curves(_large(df, "joining_year", least), "joining_year")


def by_department(df: DataFrame, least: int = 20) -> DataFrame:
    return curves(_large(df, "department", least), "department")


def logrank_statistics(df: DataFrame, cohort: str, cohorts: Sequence[str] | None = None) -> DataFrame:
    """Log-rank statistic of every pair of cohorts: group_1, group_2, test_stat.

    ``cohorts`` restricts the pairs. In long form: each event time of a cohort meets
    the numbers at risk of every other cohort at that time, and the pairs are
    summed in one aggregate. Rows grow with cohorts times event times times
    cohorts, not with staff; the pair of a time comes from its lesser cohort if
    both have events then.
    """
    known = df.filter(F.col(cohort).isNotNull())
    counts = _counts(known, F.col(cohort))
    if cohorts is not None:
        counts = counts.filter(F.col("cohort").isin(list(cohorts)))
    names = counts.agg(F.sort_array(F.collect_set("cohort")).alias("names"))
    # Cohorts by event times: both are bounded, the times by the number of days.
    times = counts.filter("d > 0").select("t").distinct().withColumn("_names", names.scalar())
    zero = F.lit(0).cast("bigint")
    grid = times.select(F.explode("_names").alias("cohort"), "t", zero.alias("d"), zero.alias("c"))
    cells = counts.unionByName(grid).groupBy("cohort", "t").agg(F.sum("d").alias("d"), F.sum("c").alias("c"))
    down = Window.partitionBy("cohort").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    risk = cells.withColumn("n", F.sum(F.col("d") + F.col("c")).over(down).cast("double"))
    one = risk.filter("d > 0").select("t", *[F.col(x).alias(f"{x}_1") for x in ("cohort", "d", "n")])
    two = risk.select("t", *[F.col(x).alias(f"{x}_2") for x in ("cohort", "d", "n")])
    met = one.join(two, "t").filter("cohort_1 != cohort_2 AND (d_2 = 0 OR cohort_1 < cohort_2)")
    first = F.col("cohort_1") < F.col("cohort_2")
    d, n = F.col("d_1") + F.col("d_2"), F.col("n_1") + F.col("n_2")
    own, at_risk = F.when(first, F.col("d_1")).otherwise(F.col("d_2")), F.when(first, F.col("n_1")).otherwise(F.col("n_2"))
    spread = d * F.col("n_1") * F.col("n_2") * (n - d) / (n * n * F.nullif(n - 1, F.lit(0.0)))
    sums = met.groupBy(F.least("cohort_1", "cohort_2").alias("group_1"), F.greatest("cohort_1", "cohort_2").alias("group_2")).agg(
        F.sum(own - d * at_risk / n).alias("z"), F.sum(F.when(n > 1, spread)).alias("v")
    )
    pairs = names.select(F.posexplode("names").alias("_i", "group_1"), "names")
    pairs = pairs.select("group_1", F.explode(F.expr("slice(names, _i + 2, size(names))")).alias("group_2"))
    stat = F.col("z") * F.col("z") / F.nullif(F.col("v"), F.lit(0.0))
    return pairs.join(sums, ["group_1", "group_2"], "left").select("group_1", "group_2", stat.alias("test_stat"))


def logrank_test(df: DataFrame, cohort: str = "college_tier", level: float = 0.05) -> DataFrame:
    """Pairwise log-rank tests with p-value and verdict."""
    stats = logrank_statistics(df, cohort).withColumn("_p", chi2_tail(F.col("test_stat")))
    return stats.select(
        "group_1",
        "group_2",
        F.round("test_stat", 4).alias("test_stat"),
        F.round("_p", 6).alias("p_value"),
        F.when(F.col("_p") < level, "Yes").otherwise("No").alias("significant"),
    )


def wide(curve: DataFrame, cohorts: Sequence[str] | None = None) -> DataFrame:
    """Curves side by side, one row per time; NULL where a cohort has no such time."""
    return curve.groupBy("t").pivot("cohort", list(cohorts) if cohorts else None).agg(F.first("survival")).orderBy("t")


def executive_summary(overall_summary: DataFrame, tier_summary: DataFrame) -> DataFrame:
    """Metric and value rows: overall retention, best and worst tier at 36 months."""
    best = tier_summary.agg(
        F.struct(
            # Ties go to the first tier by name.
            F.min_by("cohort", F.struct(-F.col("retention_36m"), F.col("cohort"))).alias("best"),
            F.min_by("cohort", F.struct(F.col("retention_36m"), F.col("cohort"))).alias("worst"),
        ).alias("t")
    ).scalar()
    median = F.coalesce(F.round("median_tenure_months", 1).cast("string"), F.lit("Not reached"))
    lines = [F.struct(F.lit("Median Retention (months)").alias("metric"), median.alias("value"))]
    for m in HORIZONS:
        value = F.round(F.col(f"retention_{m}m") * 100, 1).cast("string")
        lines.append(F.struct(F.lit(f"Retention at {m} months (%)").alias("metric"), value.alias("value")))
    for title, field in (("Best", "best"), ("Worst", "worst")):
        lines.append(
            F.struct(
                F.lit(f"{title} Retention College Tier").alias("metric"), F.col(f"_tiers.{field}").alias("value")
            )
        )
    return overall_summary.withColumn("_tiers", best).select(F.inline(F.array(*lines)))


def tier_order(tier_summary: DataFrame) -> DataFrame:
    """Tiers by retention at 36 months, lowest first."""
    return tier_summary.select("cohort", "retention_36m").orderBy("retention_36m", "cohort")
