"""Exact quantiles of any number of rows and distinct values, by narrowing intervals.

A quantile lies between two values whose places are known. Each pass asks a
mergeable quantile sketch for three values around the wanted place, counts the rows
below and at them, and keeps the open interval that must hold it, some ten
thousandth of the rows before; values that few rows are left of are fetched and
sorted. All columns and quantiles share the passes, each of which is an aggregate of one row:
nothing is shuffled, sorted or written. The sketch decides how fast this goes, never what comes out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accuracy of the sketch, distance of the outer values in places of it, and values fetched at once.
ACCURACY, WIDE, FEW = 10_000, 3, 5_000


@dataclass
class Place:
    """The value at one 0-based rank of a column: between ``low`` and ``high``, with ``below`` rows up to ``low``."""

    column: str
    rank: int
    rows: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def inside(self) -> Column:
        """The column's values in the open interval."""
        v = F.col(f"`{self.column}`")
        bounds = F.lit(True)
        if self.low is not None:
            bounds = bounds & _above(v, self.low)
        if self.high is not None:
            bounds = bounds & _above(F.lit(self.high), v)
        return F.when(v.isNotNull() & bounds, v)


def _above(a: Column, b: Column | float) -> Column:
    # Spark's order: NaN equals itself and is above every other number.
    return a > (F.lit(b) if isinstance(b, float) else b)


def _narrow(values: DataFrame, places: list[Place]) -> None:
    """Find the places' values, or bring their ends nearer."""
    asked = []
    for p in places:
        middle = (p.rank - p.below + 0.5) / p.rows
        asked.append([min(max(middle + k * WIDE / ACCURACY, 0.0), 1.0) for k in (-1, 0, 1)])
    sketches = [F.percentile_approx(p.inside(), a, ACCURACY) for p, a in zip(places, asked, strict=True)]
    points = [sorted(set(r), key=_key) for r in values.agg(*[c.alias(f"p{i}") for i, c in enumerate(sketches)]).first()]
    counts = []
    for p, xs in zip(places, points, strict=True):
        for x in xs:
            v = p.inside()
            counts += [F.count_if(_above(F.lit(x), v)), F.count_if(v == F.lit(x))]
    found = iter(values.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first())
    for p, xs in zip(places, points, strict=True):
        low, high, below, rows = p.low, p.high, p.below, p.rows
        for x in xs:
            less, equal = next(found), next(found)
            if p.value is not None:
                continue
            if p.below + less <= p.rank < p.below + less + equal:
                p.value = x
            elif p.rank < p.below + less:
                if high is p.high:
                    high, rows = x, p.below + less - below
            else:
                low, below = x, p.below + less + equal
                rows = p.below + p.rows - below
        p.low, p.high, p.below, p.rows = low, high, below, rows


def _key(x: float) -> tuple[bool, float]:
    return (x != x, 0.0 if x != x else x)


def _fetch(values: DataFrame, places: list[Place]) -> None:
    """The values of intervals with few rows."""
    row = values.agg(*[F.sort_array(F.collect_list(p.inside())).alias(f"v{i}") for i, p in enumerate(places)]).first()
    for p, found in zip(places, row, strict=True):
        p.value = found[p.rank - p.below]


def values_at(df: DataFrame, ranks: Mapping[str, Sequence[int]], rows: Mapping[str, int]) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of the non-NULL values of columns, whose numbers are ``rows``."""
    values = df.select([F.col(f"`{c}`").cast("double").alias(c) for c in ranks])
    places = [Place(c, r, rows[c]) for c, rs in ranks.items() for r in sorted(set(rs))]
    while open_places := [p for p in places if p.value is None]:
        few = [p for p in open_places if p.rows <= FEW]
        if few:
            _fetch(values, few)
        many = [p for p in open_places if p.rows > FEW]
        if many:
            _narrow(values, many)
    return {(p.column, p.rank): p.value for p in places}


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """One row per column with each named quantile, linearly interpolated; NULLs skipped.

    A column without values has no row. ``df`` is read once for each pass: some
    twice for millions of rows, once more for every further ten-thousandfold.
    """
    counted = df.agg(*[F.count(F.col(f"`{c}`").cast("double")).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    rows = {c: n for c, n in zip(columns, counted, strict=True) if n}
    spots = {(c, name): q * (n - 1) for c, n in rows.items() for name, q in quantiles.items()}
    ranks = {c: [r for name in quantiles for r in (math.floor(spots[c, name]), math.ceil(spots[c, name]))] for c in rows}
    found = values_at(df, ranks, rows) if rows else {}
    out = []
    for c in rows:
        line = [c]
        for name in quantiles:
            spot = spots[c, name]
            low, high = found[c, math.floor(spot)], found[c, math.ceil(spot)]
            line.append(low if low == high else low + (high - low) * (spot - math.floor(spot)))
        out.append(tuple(line))
    schema = ", ".join(["column_name string", *[f"`{name}` double" for name in quantiles]])
    return df.sparkSession.createDataFrame(out, schema)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max in one row."""
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    places = exact_quantiles(df, [column], quartiles).first()
    return df.agg(
        F.lit(column).alias("column_name"),
        F.count(column).alias("count"),
        (F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    ).select(
        "column_name",
        "count",
        "mean",
        "std",
        "min",
        *[F.lit(places[name] if places else None).cast("double").alias(name) for name in quartiles],
        "max",
    )
