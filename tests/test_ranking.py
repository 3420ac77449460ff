"""Ranks, tiles, lags and quantiles against plain windows, with hot values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollcall.operators import quantiles, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; a third share one value and one key; some values are NULL."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        value = 500 if hot else rng.randint(0, 2000)
        rows.append((i, "hot" if hot else f"k{rng.randint(0, 40)}", value, rng.choice(["a", "b", None])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id bigint, key string, value bigint, grp string").repartition(7).cache()


def rows(df, *columns):
    return sorted(tuple(str(v) for v in r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("tiles", [1, 3, 4, 7])
def test_global_ntile_is_the_plain_one(skewed, tiles):
    order = [F.desc("value"), F.asc("id")]
    got = ranking.global_ntile(skewed, tiles, *order, name="t")
    want = skewed.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    assert rows(got, "id", "t") == rows(want, "id", "t")


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.range(3)
    got = ranking.global_ntile(df, 5, "id", name="t")
    assert [r["t"] for r in got.orderBy("id").collect()] == [1, 2, 3]


def test_row_number_and_grouped_row_number(skewed):
    got = ranking.global_row_number(skewed, "value", "id", name="n")
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy("value", "id")))
    assert rows(got, "id", "n") == rows(want, "id", "n")
    got = ranking.grouped_row_number(skewed, "key", "value", "id", name="n")
    want = skewed.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("value", "id")))
    assert rows(got, "id", "n") == rows(want, "id", "n")


@pytest.mark.parametrize("by", [(), ("grp",)])
@pytest.mark.parametrize("descending", [True, False])
def test_value_ranks(skewed, by, descending):
    order = F.desc("value") if descending else F.asc("value")
    window = Window.partitionBy(*by).orderBy(order)
    want = skewed.withColumn("rank", F.rank().over(window)).withColumn("p", F.percent_rank().over(window))
    got = ranking.value_ranks(skewed, "value", by, descending)
    share = (F.col("rank") - 1) / (F.col("rank_all") - 1)
    assert rows(got.withColumn("p", share), "id", "rank", "p") == rows(want, "id", "rank", "p")


def test_small_ranks(skewed):
    window = Window.partitionBy("grp").orderBy(F.desc("value"))
    got = ranking.small_ranks(skewed, "value", ["grp"], descending=True, dense=True)
    assert rows(got, "id", "rank") == rows(skewed.withColumn("rank", F.dense_rank().over(window)), "id", "rank")
    got = ranking.small_ranks(skewed, "value")
    want = skewed.withColumn("rank", F.rank().over(Window.orderBy("value")))
    assert rows(got, "id", "rank") == rows(want, "id", "rank")


def test_average_ranks_are_those_of_pandas(skewed):
    got = ranking.average_ranks(skewed, "value").select("id", "rank").toPandas().set_index("id")["rank"]
    frame = skewed.select("id", "value").toPandas().set_index("id")
    want = frame["value"].rank()
    assert (got.sort_index() == want.sort_index()).all()


@pytest.mark.parametrize("key", ["key", "grp"])
def test_previous_value_plain_and_ranged(skewed, spark, key):
    want = skewed.withColumn("p", F.lag("value").over(Window.partitionBy(key).orderBy("value", "id")))
    plain = ranking.previous_value(skewed, key, ["value", "id"], "value", "p")
    assert rows(plain, "id", "p") == rows(want, "id", "p")
    spark.conf.set("rollcall.task.rows", "3")
    try:
        ranged = ranking.previous_value(skewed, key, ["value", "id"], "value", "p")
        assert rows(ranged, "id", "p") == rows(want, "id", "p")
    finally:
        spark.conf.unset("rollcall.task.rows")


def test_hot_value_spreads_over_ranges(skewed):
    cells = ranking.spread(skewed, F.col("value"), F.col("id"))
    ranges = cells.filter("value = 500").select(ranking.RANGE).distinct().count()
    assert ranges > 1


def test_top_ranked_keeps_true_ranks(skewed):
    got = ranking.top_ranked(skewed, 20, "value", "id", "r").select("id", "r")
    full = skewed.withColumn("r", F.rank().over(Window.orderBy(F.desc("value"))))
    want = full.orderBy("r", "id").limit(20)
    assert rows(got, "id", "r") == rows(want, "id", "r")


def test_exact_quantiles(skewed):
    frame = skewed.toPandas()
    got = {
        r["column_name"]: r
        for r in quantiles.exact_quantiles(skewed, ["value", "id"], {"q1": 0.25, "m": 0.5, "q9": 0.9}).collect()
    }
    for column in ("value", "id"):
        for name, q in (("q1", 0.25), ("m", 0.5), ("q9", 0.9)):
            assert got[column][name] == pytest.approx(np.quantile(frame[column], q), abs=1e-9)


def test_describe_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "x double")
    row = quantiles.describe(df, "x").first().asDict()
    assert (row["count"], row["mean"], row["min"], row["median"], row["max"]) == (2, 2.5, 1.0, 2.5, 4.0)


def test_no_base_rows_in_a_single_task(skewed):
    """The plan moves ranges and counts to one task, never rows."""
    df = ranking.global_ntile(skewed, 4, "value", "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert "Aggregate" in plan.split(line, 1)[1].splitlines()[1]


@pytest.mark.parametrize("few", [5_000, 3, 0])
def test_quantiles_by_many_passes(spark, monkeypatch, few):
    """Ties, signs, infinities and gaps; with ``few`` at 0 every value is found by counting alone."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "ACCURACY", 20)
    rng = random.Random(few)
    rows = [(rng.choice([0.0, -1.5, 7.0, 1e300]) if i % 3 else rng.gauss(0, 1e6), float(rng.randint(0, 9)), None) for i in range(700)]
    rows += [(float("inf"), None, None), (float("-inf"), 4.0, None), (None, 4.0, None)]
    df = spark.createDataFrame(rows, "`a b` double, c double, empty double").repartition(5)
    asked = {"low": 0.0, "q": 0.25, "m": 0.5, "odd": 0.377, "high": 1.0}
    got = {r["column_name"]: r for r in quantiles.exact_quantiles(df, ["a b", "c", "empty"], asked).collect()}
    assert set(got) == {"a b", "c"}
    for i, name in enumerate(["a b", "c"]):
        values = sorted(r[i] for r in rows if r[i] is not None)
        for label, q in asked.items():
            spot = q * (len(values) - 1)
            a, b = values[math.floor(spot)], values[math.ceil(spot)]
            assert got[name][label] == (a if a == b else a + (b - a) * (spot - math.floor(spot)))


def test_quantiles_write_nothing(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a table was written")

    monkeypatch.setattr(ranking, "written", refuse)
    assert quantiles.exact_quantiles(spark.range(101), ["id"], {"m": 0.5}).first()["m"] == 50.0
    assert quantiles.describe(spark.range(0), "id").first()["median"] is None
