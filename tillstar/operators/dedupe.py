"""Keep the first row per key, and list the others, without a task that sees a whole group.

Keys that occur once, normally almost all, only take part in a count per key. The rows behind
repeated keys are the only ones that are compared with each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.skew import join_repeated
from tillstar.session import stored


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row and their number in ``_rows``; only the keys are shuffled."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)


def first_by_minimum(df: DataFrame, keys: list[str], order: str, copies: str = "Source_Rows") -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    A minimum combines before the shuffle, so many copies of one key cost one row per task
    (a row_number window would sort them all in a single task). ``copies`` counts the input rows.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    first = F.min(F.struct(order, *rest)).alias("_first")
    grouped = df.groupBy(*keys).agg(first, F.count(F.lit(1)).alias(copies))
    return grouped.select(*keys, f"_first.{order}", *[f"_first.{c}" for c in rest], copies)


def keep_first(
    df: DataFrame, keys: list[str], order: str, repeated: DataFrame, copies: str = "Source_Rows"
) -> DataFrame:
    """``first_by_minimum`` with the repeated keys known: all other rows pass without a shuffle of
    their own (while ``repeated`` is small enough to be broadcast, which Spark decides)."""
    names = repeated.select(*keys)
    single = df.join(names, keys, "left_anti").withColumn(copies, F.lit(1).cast("bigint"))
    return single.unionByName(first_by_minimum(df.join(names, keys, "left_semi"), keys, order, copies))


def surplus_rows(
    df: DataFrame, keys: list[str], order: str, repeated: DataFrame | None = None, copies: str = "Copies"
) -> DataFrame:
    """Every row that ``keep_first`` leaves out; equal rows come once with their number in ``copies``.

    Rows of repeated keys are stored in between, because they are read several times from here on.
    Equal ones collapse before the last join, and hot keys are joined by broadcast.
    """
    if repeated is None:
        repeated = stored(repeated_keys(df, keys), "repeated_keys")
    suspects = join_repeated(df, repeated, keys, "_rows").drop("_rows")
    collapsed = stored(suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies)), "repeated_rows")
    row = F.struct(order, *[c for c in df.columns if c not in keys and c != order])
    firsts = collapsed.groupBy(*keys).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    left_over = F.col(copies) - (row == F.col("_first")).cast("long")
    return (
        join_repeated(collapsed, firsts, keys, "_rows")
        .withColumn(copies, left_over)
        .where(F.col(copies) > 0)
        .drop("_first", "_rows")
    )
