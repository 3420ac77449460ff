"""First, last and newest values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key.

    ``row_number() = 1`` is planned as a group limit before and after the
    shuffle, so a hot key sends one row per map task.
    """
    window = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


SERIAL_LIMIT = 10**14


def order_key(major: Column, serial: Column, wide: bool = False) -> Column:
    """(major, serial) as one number, which keeps min_by/max_by a hash aggregate.

    A struct would do the same but forces a sort aggregate. The number is a
    BIGINT, good for serials below 10^14 and a day or year as ``major``; a larger
    serial raises an error rather than spoil the order. ``wide`` takes any
    BIGINT serial, at the price of DECIMAL arithmetic.
    """
    if wide:
        shifted = major.cast("decimal(18,0)") * F.lit(Decimal(10**19))
        return (shifted + serial.cast("decimal(19,0)")).cast("decimal(38,0)")
    fits = serial.isNull() | ((serial >= 0) & (serial < SERIAL_LIMIT))
    key = major.cast("bigint") * SERIAL_LIMIT + serial.cast("bigint")
    return F.when(fits, key).otherwise(F.raise_error(F.lit("serial key above 10^14: use wide=True")).cast("bigint"))


def last_value(value: str | Column, order: Column) -> Column:
    """Last non-NULL value in ``order``, as an aggregate."""
    value = F.col(value) if isinstance(value, str) else value
    return F.max_by(value, F.when(value.isNotNull(), order))


def first_value(value: str | Column, order: Column) -> Column:
    """First non-NULL value in ``order``, as an aggregate."""
    value = F.col(value) if isinstance(value, str) else value
    return F.min_by(value, F.when(value.isNotNull(), order))
