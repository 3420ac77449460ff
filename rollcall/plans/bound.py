"""Tables and shared intermediate results a registered query starts from."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators import managers, rules, survival
from rollcall.plans import flows
from rollcall.schema import bands_frame, merit_frame, promotion_rules_frame
from rollcall.sources.scratch import written
from rollcall.sources.star import TEST_BANDS, TEST_DIFFICULTY, TRAIN_CUTOFF, bind


class Bound:
    """One data directory bound to one session; lazily built, built once."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self.t = bind(spark, directory)
        self.as_of = self.t.as_of
        for name, df in self.t.tables().items():
            setattr(self, name, df)

    @cached_property
    def bands(self) -> DataFrame:
        return bands_frame(self.spark, TEST_BANDS)

    @cached_property
    def survival(self) -> DataFrame:
        return survival.survival_input(self.t.employees, self.t.exits, self.as_of)

    @property
    def card(self) -> DataFrame:
        return managers.scorecard(self.t.employees, self.t.performance, self.t.compensation, self.t.learning)

    @cached_property
    def state(self) -> DataFrame:
        t = self.t
        return rules.career_state(t.employees, t.performance, t.learning, t.exits, self.as_of)

    @cached_property
    def promotion_rules(self) -> DataFrame:
        return promotion_rules_frame(self.spark)

    @cached_property
    def merit(self) -> DataFrame:
        return merit_frame(self.spark)

    @property
    def rule_scores(self) -> DataFrame:
        """The attrition scorecard as a score column, for metrics that need a fixed one."""
        scored = rules.attrition_score(
            self.state, self.t.compensation, self.t.projects, self.bands, TEST_DIFFICULTY
        ).select("employee_id", F.col("attrition_prob").alias("prob"))
        label = self.t.employees.select(
            "employee_id",
            (F.col("status") == "Exited").cast("int").alias("attrition"),
            F.year("joining_date").alias("joining_year"),
        )
        return label.join(scored, "employee_id").withColumn(
            "predicted_attrition", (F.col("prob") >= 0.05).cast("int")
        )

    @cached_property
    def matrix(self) -> DataFrame:
        return written(flows.feature_matrix(self.t.tables(), self.as_of), "matrix")

    def train(self) -> flows.Trained:
        return flows.run_training(self.matrix, TRAIN_CUTOFF)

    @cached_property
    def trained(self) -> flows.Trained:
        """The model the scoring and explanation queries share."""
        return self.train()

    @cached_property
    def explained(self) -> dict[str, DataFrame]:
        return flows.run_explanation(self.trained)


_bound: dict[tuple[str, str], Bound] = {}


def bound(spark: SparkSession, directory: str) -> Bound:
    key = (spark.sparkContext.applicationId, directory)
    if key not in _bound:
        _bound[key] = Bound(spark, directory)
    return _bound[key]


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and fractions as DOUBLE, as the SQL side has them."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)
