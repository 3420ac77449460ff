"""Column expressions: calendar, rounding, first and last values, buckets."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollcall.functions import buckets, dates, measures, picks


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "later, earlier, years, months",
    [
        ("2021-02-28", "2020-02-29", 0, 11),
        ("2021-01-01", "2020-12-31", 0, 0),
        ("2021-01-01", "2020-01-01", 1, 12),
        ("2020-01-01", "2021-01-01", -1, -12),
        ("2020-01-01", "2020-06-15", 0, -5),
        ("2024-03-31", "2024-02-29", 0, 1),
    ],
)
def test_full_years_and_months(spark, later, earlier, years, months):
    df = spark.createDataFrame([(dt.date.fromisoformat(later), dt.date.fromisoformat(earlier))], "a date, b date")
    row = df.select(dates.full_years(F.col("a"), F.col("b")), dates.full_months(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (years, months)


def test_rounding_half_up_and_half_even(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (1, 3), (0, 5), (2, 0)], "n bigint, d bigint")
    n, d = F.col("n"), F.col("d")
    rows = df.select(measures.percent(n, d), measures.percent(n, d, even=True)).collect()
    # 0.125 and 0.375 are ties.
    assert [tuple(r) for r in rows] == [(0.13, 0.12), (0.38, 0.38), (33.33, 33.33), (0.0, 0.0), (None, None)]


def test_percent_of_random_counts_is_exact(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(0, m), m) for m in (rng.randint(1, 10**7) for _ in range(500))]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [tuple(r) for r in df.select("n", "d", measures.percent(F.col("n"), F.col("d"))).collect()]
    for n, d, p in got:
        whole = (2 * n * 10000 + d) // (2 * d)
        assert p == whole / 100


def test_mean_is_half_up_on_the_exact_quotient(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("1.00"),)], "x decimal(12,2)")
    assert one(df.agg(measures.mean("x", 2))) == 0.51  # 0.505
    assert one(df.agg(measures.mean("x", 2, even=True))) == 0.5


def test_shares_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    total = one(measures.with_share(df, "n", "p").agg(F.sum("p")))
    assert abs(total - 100) < 0.05


def test_first_and_last_skip_nulls_but_newest_row_does_not(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), 1, 10), (1, dt.date(2021, 1, 1), 2, None)], "k int, d date, id bigint, v int"
    )
    order = picks.order_key(F.unix_date("d"), F.col("id"))
    row = df.groupBy("k").agg(picks.last_value("v", order), picks.first_value("v", order)).first()
    assert tuple(row) == (1, 10, 10)
    assert picks.newest(df, "k", "d", "id").first()["v"] is None


def test_newest_breaks_ties_by_serial(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), i, f"r{i}") for i in range(5)], "k int, d date, id bigint, v string"
    )
    assert picks.newest(df, "k", "d", "id").first()["v"] == "r4"


def test_order_key_refuses_large_serials_unless_wide(spark):
    df = spark.createDataFrame([(2020, 10**15), (2021, 1)], "y int, id bigint")
    wide = picks.order_key(F.col("y"), F.col("id"), wide=True)
    assert df.orderBy(wide).first()["y"] == 2020
    with pytest.raises(Exception, match="wide=True"):
        df.select(picks.order_key(F.col("y"), F.col("id"))).collect()


def test_tenure_months_agree_with_pandas(spark):
    days = list(range(0, 4000, 7))
    start = dt.date(2010, 1, 1)
    df = spark.createDataFrame([(start, start + dt.timedelta(d)) for d in days], "a date, b date")
    got = [r[0] for r in df.select(dates.tenure_months(F.col("b"), F.col("a"))).collect()]
    assert got == (pd.Series(days) / 30.44).round(2).tolist()


def test_quarter_and_month_labels(spark):
    df = spark.createDataFrame([(dt.date(2021, 11, 5),)], "d date")
    row = df.select(dates.quarter_label(F.col("d")), dates.month_label(F.col("d"))).first()
    assert tuple(row) == ("2021Q4", "2021-11")


def test_lenient_dates(spark):
    df = spark.createDataFrame([("2020-02-30",), ("soon",), ("2020-02-29",), (None,)], "s string")
    got = [r[0] for r in df.select(dates.lenient_date(F.col("s"))).collect()]
    assert got == [None, None, dt.date(2020, 2, 29), None]


def test_right_closed_buckets(spark):
    df = spark.createDataFrame([(0.0,), (20.0,), (20.1,), (100.0,), (100.1,), (None,)], "v double")
    edges = ((20, "Very Low"), (40, "Low"), (100, "Critical"))
    got = [r[0] for r in df.select(buckets.right_closed(F.col("v"), 0, edges)).collect()]
    assert got == [None, "Very Low", "Low", "Critical", None, None]


def test_equal_bins_close_the_last(spark):
    values = [0.0, 0.0249, 0.025, 0.5, 0.999, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(buckets.equal_bins(F.col("v"), 40)).collect()]
    assert got == [0, 0, 1, 20, 39, 39]
    assert np.histogram(values, bins=np.linspace(0, 1, 41))[0].sum() == len(values)
