"""Dense surrogate keys 1..n in natural-key order, for tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.session import write_if_empty


def write_sorted(df: DataFrame, key: str, path: str) -> None:
    """Range-partition and sort by ``key``: files hold disjoint key ranges, row groups prune by it.

    A table that holds rows stays as it is.
    """
    write_if_empty(df.repartitionByRange(key).sortWithinPartitions(key), path)


def read_with_dense_key(spark: SparkSession, path: str, key: str, key_name: str) -> DataFrame:
    """Number the rows of a table that ``write_sorted`` wrote.

    The stored files fix the numbering: a row's key is its position in its file plus the rows of
    the files before it. Only one row per file is windowed and broadcast, the table is not shuffled.
    """
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_position")
    )
    files = rows.groupBy("_file").agg(F.min(key).alias("_low"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = rows.join(F.broadcast(offsets), "_file")
    return numbered.withColumn(key_name, F.col("_before") + F.col("_position") + 1).drop(
        "_file", "_position", "_before"
    )


def key_page(table: DataFrame, key: str, start, size: int = 500) -> DataFrame:
    """The first ``size`` rows with ``key >= start`` in key order."""
    return table.where(F.col(key) >= F.lit(start)).orderBy(key).limit(size)
