"""Order statistics without a single-task window.

A window with no PARTITION BY, or with a handful of partitions, sorts the whole
table in as many tasks. Here rows are range-partitioned on the sort key
instead: each range is numbered by itself and shifted by the sizes of the
ranges before it. Rows with the same sort key are first collapsed to a count,
or told apart by a unique last key, so a hot value does not make a hot range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.sources.scratch import written

RANGE = "_range"
# Rows of one key that a single task may sort; `rollcall.task.rows` overrides it.
TASK_ROWS = 5_000_000


def task_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("rollcall.task.rows", str(TASK_ROWS)))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left key columns."""
    if not keys:
        raise ValueError("join_on needs at least one key")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def spread(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` in contiguous ranges of ``order``; ``_range`` numbers them in that order.

    The ranges are written out: sampling picks them, so a second evaluation
    could cut elsewhere.
    """
    ranged = df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id())
    return written(ranged, "ranges")


def running_totals(
    df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, Column | str], by: Sequence[str] = ()
) -> DataFrame:
    """``df`` with the running total of each of ``totals`` in ``order``.

    ``totals`` maps a new column to what it sums; ``<name>_all`` is the total of
    the whole group ``by``. The order must be total (unique) within a group.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    cells = spread(df, *[F.col(c) for c in by], *order)
    inner = Window.partitionBy(RANGE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = cells.select("*", *[F.sum(v).over(inner).alias(n) for n, v in totals.items()])
    # One row per range and group: ranges are contiguous, so this stays small.
    sums = cells.groupBy(RANGE, *by).agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    shifts = sums.select(
        RANGE,
        *by,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in totals],
        *[F.sum(n).over(whole).alias(f"{n}_all") for n in totals],
    )
    out = join_on(within, shifts, [RANGE, *by])
    for n in totals:
        out = out.withColumn(n, F.col(n) + F.col(f"_before_{n}"))
    return out.drop(RANGE, *[f"_before_{n}" for n in totals])


def global_row_number(df: DataFrame, *order: Column | str, name: str = "row_number") -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) with ``<name>_all`` rows in total."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")})


def grouped_row_number(df: DataFrame, by: str, *order: Column | str, name: str = "row_number") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY by ORDER BY order); a key may span many ranges."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, [by]).drop(f"{name}_all")


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a row number and the number of rows."""
    size = F.floor(rows / tiles)
    longer = rows % tiles
    cut = longer * (size + 1)
    late = longer + F.floor((position - 1 - cut) / F.greatest(size, F.lit(1))) + 1
    return F.when(position <= cut, F.floor((position - 1) / (size + 1)) + 1).otherwise(late).cast("int")


def global_ntile(df: DataFrame, tiles: int, *order: Column | str, name: str = "ntile") -> DataFrame:
    """NTILE(tiles) OVER (ORDER BY order); end the order with a unique key."""
    numbered = global_row_number(df, *order, name="_position")
    tile = tile_of(F.col("_position"), F.col("_position_all"), tiles)
    return numbered.withColumn(name, tile).drop("_position", "_position_all")


def value_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False, name: str = "rank"
) -> DataFrame:
    """RANK() OVER (PARTITION BY by ORDER BY value), and ``<name>_all`` rows per group.

    Works on (group, value, count), so ties and hot values cost one row each.
    """
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_rows"))
    order = F.desc(value) if descending else F.asc(value)
    ranks = running_totals(counts, [order], {name: "_rows"}, by).select(
        *by, value, (F.col(name) - F.col("_rows") + 1).alias(name), f"{name}_all"
    )
    return join_on(df, ranks, [*by, value])


def small_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False, dense: bool = False, name: str = "rank"
) -> DataFrame:
    """RANK or DENSE_RANK of a value with few distinct values per group.

    For percentages of two digits, at most 10,001 per group: the window sorts
    the distinct values, never the rows.
    """
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_rows"))
    order = F.desc(value) if descending else F.asc(value)
    window = Window.partitionBy(*by).orderBy(order)
    if dense:
        rank = F.row_number().over(window)
    else:
        rank = F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows") + 1
    ranks = counts.select(*by, value, rank.cast("bigint").alias(name))
    return join_on(df, ranks, [*by, value])


def average_ranks(df: DataFrame, value: str, descending: bool = False, name: str = "rank") -> DataFrame:
    """Rank in which ties share the mean of their positions."""
    counts = df.groupBy(value).agg(F.count("*").alias("_rows"))
    order = F.desc(value) if descending else F.asc(value)
    ranks = running_totals(counts, [order], {"_upto": "_rows"}).select(
        value, (F.col("_upto") - (F.col("_rows") - 1) / 2).alias(name)
    )
    return join_on(df, ranks, [value])


def largest_group(df: DataFrame, *keys: str) -> int:
    """Rows of the most frequent key; counted map-side first."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def previous_value(df: DataFrame, key: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """LAG(value) OVER (PARTITION BY key ORDER BY order).

    A plain window while every key fits a task. Beyond that the history is cut
    into ranges of (key, order), so one key may span many tasks, and the last
    row of a range is handed to the next one.
    """
    if largest_group(df, key) <= task_rows(df):
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(*order)))
    cells = spread(df, key, *order)
    inner = Window.partitionBy(RANGE).orderBy(key, *order)
    lagged = cells.select(
        "*",
        F.row_number().over(inner).alias("_row"),
        F.lag(key).over(inner).alias("_key"),
        F.lag(value).over(inner).alias("_value"),
    )
    place = F.struct(key, *order)
    # One row per range.
    ends = cells.groupBy(RANGE).agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(value).alias("v")), place).alias("e"))
    handed = ends.select(RANGE, F.lag("e").over(Window.orderBy(RANGE)).alias("_end"))
    first = F.col("_row") == 1
    prior_key = F.when(first, F.col("_end.k")).otherwise(F.col("_key"))
    prior = F.when(first, F.col("_end.v")).otherwise(F.col("_value"))
    return (
        lagged.join(handed, RANGE)
        .withColumn(name, F.when(prior_key.eqNullSafe(F.col(key)), prior))
        .drop(RANGE, "_row", "_key", "_value", "_end")
    )


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of a total order: each task keeps ``n`` rows."""
    return df.orderBy(*order).limit(n)


def top_ranked(df: DataFrame, n: int, value: str, tie: str, name: str) -> DataFrame:
    """First ``n`` rows by RANK() over ``value`` descending, ties by ``tie``.

    Every row ahead of a kept row is kept as well, so ranking the ``n`` rows
    gives their ranks in the whole table.
    """
    head = top(df, n, F.desc(value), F.asc(tie))
    return head.withColumn(name, F.rank().over(Window.orderBy(F.desc(value)))).orderBy(name, tie)
