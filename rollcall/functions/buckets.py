"""Bucketing by fixed edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def below(value: Column, edges: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first edge that ``value`` lies below (left-closed buckets)."""
    (edge, label), *more = edges
    chain = F.when(value < edge, label)
    for edge, label in more:
        chain = chain.when(value < edge, label)
    return chain.otherwise(rest)


def right_closed(value: Column, floor: float, edges: Sequence[tuple[float, str]]) -> Column:
    """Label of the bucket (lower, upper] that holds ``value``; NULL outside."""
    chain = F.when(value <= floor, F.lit(None).cast("string"))
    for edge, label in edges:
        chain = chain.when(value <= edge, label)
    return chain


def equal_bins(value: Column, bins: int) -> Column:
    """Bin number of a value in [0, 1]; the last bin is closed."""
    return F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int")
