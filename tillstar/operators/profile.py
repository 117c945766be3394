"""Profiles of the raw inputs: value counts, summaries, ranges and frequent keys."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import numeric
from tillstar.operators.frequent import top_keys
from tillstar.session import stored

QUARTILES = (0.25, 0.5, 0.75)
SKETCH_BITS = 16  # 2^16 registers: a standard error of about 0.4 %, a fifth of what sketch_check allows
RANGES = 1024  # in which values are counted to find a quantile
FEW = 4096  # distinct values that are looked at one by one


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per non-null value of every column, from one scan, in long form."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("Column_Name"), F.col(c).cast("string").alias("Value")) for c in columns
    ])
    return (
        df.select(F.inline(pairs))
        .where("Value is not null")
        .groupBy("Column_Name", "Value")
        .agg(F.count(F.lit(1)).alias("Row_Count"))
        .orderBy("Column_Name", "Value")
    )


def counts_by_frequency(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("Row_Count"))
        .orderBy(F.desc("Row_Count"), column)
    )


def counts_by_value(df: DataFrame, column: str) -> DataFrame:
    return counts_by_frequency(df, column).orderBy(column)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct non-null values per column; duplicates combine before the shuffle."""
    return (
        value_counts(df, columns)
        .groupBy("Column_Name")
        .agg(F.count(F.lit(1)).alias("Distinct_Values"))
    )


def distinct_sketches(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """A sketch of the distinct values of every column for each day: days are added by a union of sketches, not counted again."""
    return df.groupBy(day).agg(*[F.hll_sketch_agg(F.xxhash64(c), F.lit(SKETCH_BITS)).alias(c) for c in columns])


def sketched_counts(daily: DataFrame, columns: list[str]) -> DataFrame:
    """Estimated distinct values per column over all days of ``distinct_sketches``."""
    estimates = F.array(*[
        F.struct(F.lit(c).alias("Column_Name"), F.hll_sketch_estimate(F.col(c)).alias("Estimate")) for c in columns
    ])
    return daily.agg(*[F.hll_union_agg(c).alias(c) for c in columns]).select(F.inline(estimates))


def sketch_check(df: DataFrame, daily: DataFrame, columns: list[str], percent: int = 2) -> DataFrame:
    """Exact distinct values per column, and whether the sketches' estimate is off by less than ``percent``."""
    off = F.abs(F.col("Estimate") - F.col("Distinct_Values")) * 100 < F.col("Distinct_Values") * percent
    return distinct_counts(df, columns).join(sketched_counts(daily, columns), "Column_Name").select(
        "Column_Name", "Distinct_Values", off.cast("int").alias("Sketch_Is_Near")
    )


def _quantiles(per_value: DataFrame, shares: tuple[float, ...]) -> list[float | None]:
    """Exact, interpolated quantiles of values ``v`` that occur ``n`` times, without bringing all values together.

    A wanted rank is looked for in an interval of values: they are counted in equal ranges, and the range that holds the rank
    becomes the next interval, from its smallest to its largest value, until at most ``FEW`` distinct values are
    left. So outliers cost a round of counting (a range is a thousandth of the interval), never a large task.
    """
    counted = stored(per_value, "value_counts")
    low, high, total, distinct = counted.agg(F.min("v"), F.max("v"), F.sum("n"), F.count(F.lit(1))).first()
    if not total:
        return [None] * len(shares)
    spots = [q * (total - 1) for q in shares]
    whole = (low, high, 0, distinct)
    found = {rank: whole for s in spots for rank in (math.floor(s), math.ceil(s))}
    while wide := {interval for interval in found.values() if interval[3] > FEW}:
        for interval in wide:
            ranges = _counted_ranges(counted, *interval[:2])
            for rank in [r for r, held in found.items() if held == interval]:
                before = interval[2]
                for part in ranges:
                    if before <= rank < before + part.n:
                        found[rank] = (part.low, part.high, before, part.distinct)
                        break
                    before += part.n
    value = {}
    for low, high, before, _ in set(found.values()):
        reached = before
        for v, n in counted.where(F.col("v").between(low, high)).select("v", "n").orderBy("v").collect():  # at most FEW rows
            value |= {rank: float(v) for rank, held in found.items() if held[:3] == (low, high, before) and reached <= rank < reached + n}
            reached += n
    return [value[math.floor(s)] + (value[math.ceil(s)] - value[math.floor(s)]) * (s - math.floor(s)) for s in spots]


def _counted_ranges(counted: DataFrame, low, high) -> list:
    """Rows, distinct values, smallest and largest value of equal ranges between ``low`` and ``high``: ``RANGES`` + 1 at most."""
    width = float(high) - float(low) or 1.0
    place = F.floor((F.col("v").cast("double") - float(low)) * (RANGES / width))
    parts = counted.where(F.col("v").between(low, high)).groupBy(place.alias("place")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    return parts.orderBy("place").collect()


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles (interpolated) and maximum.

    The quartiles are taken from rows per distinct value (a price in cents, a quantity), not from rows.
    """
    value = F.col(column).cast("decimal(12,2)")
    present = df.where(F.col(column).isNotNull())
    per_value = present.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    quartiles = _quantiles(per_value, QUARTILES)
    totals = present.agg(
        F.count(F.lit(1)).alias("Value_Count"),
        F.sum(value).alias("total"),
        F.stddev_samp(value.cast("double")).alias("deviation"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    return totals.select(
        "Value_Count",
        numeric.mean(F.col("total"), F.col("Value_Count")).cast("double").alias("Mean"),
        F.round("deviation", 6).alias("Std_Dev"),
        F.col("low").cast("double").alias("Minimum"),
        *[F.round(F.lit(q).cast("double"), 6).alias(name) for q, name in zip(quartiles, ("Quartile_1", "Median", "Quartile_3"))],
        F.col("high").cast("double").alias("Maximum"),
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("First_Date"), F.max(column).alias("Last_Date"))


def rows_per_year(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.year(column).alias("Year"))
        .agg(F.count(F.lit(1)).alias("Row_Count"))
        .orderBy("Year")
    )


def hot_keys(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """The most frequent keys; ties go to the smaller key."""
    return top_keys(df, key, top)


def head(df: DataFrame, keys: list[str], rows: int = 5) -> DataFrame:
    """The first rows in key order (a table has no order of its own)."""
    return df.orderBy(*keys).limit(rows)
