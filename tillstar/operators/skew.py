"""Finding keys that hold a large share of a table, with a proven bound on how many there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000
HOT_MIN_ROWS = 1_000_000


def hot_keys(
    df: DataFrame, keys: list[str], share: int = HOT_SHARE, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Keys with more than ``1/share`` of all rows (and more than ``min_rows``), with ``_rows``.

    Fewer than ``share`` keys can exceed ``1/share`` of the rows, so the result may be broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.agg(F.count(F.lit(1)))
    return counts.where((F.col("_rows") > min_rows) & (F.col("_rows") * share > total.scalar()))


def with_salt(df: DataFrame, keys: list[str], spread_over: list[Column], share: int = HOT_SHARE,
              min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """Adds ``_salt``: 0 for ordinary keys, one of up to ``_rows / min_rows`` values for hot keys."""
    hot = hot_keys(df, keys, share, min_rows)
    slots = F.ceil(F.col("_rows") / min_rows)
    salt = F.when(F.col("_rows").isNotNull(), F.pmod(F.xxhash64(*spread_over), slots)).otherwise(0)
    return df.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_rows")


def join_repeated(left: DataFrame, right: DataFrame, keys: list[str], rows: str, share: int = HOT_SHARE) -> DataFrame:
    """Inner join with ``right``, which has one row per key and the number of left rows in ``rows``.

    Keys that hold more than ``1/share`` of the left rows (fewer than ``share`` keys) are joined by
    broadcast, so their rows are never shuffled to one task; the rest joins by its keys.
    """
    total = left.agg(F.count(F.lit(1)))
    is_hot = F.col(rows) * share > total.scalar()
    hot = F.broadcast(right.where(is_hot))
    cold_left = left.join(F.broadcast(right.where(is_hot).select(*keys)), keys, "left_anti")
    return left.join(hot, keys).unionByName(cold_left.join(right.where(~is_hot), keys))
