"""The saved form of the quarterly store report: refreshed from new loads, read without touching the facts.

``quarter_parts`` has, for each load, sums per quarter, store and customer. They merge by addition, and customers are rows,
so the number of different customers stays exact. ``saved_quarters`` has the sums per quarter and store in versions: a
refresh writes the quarters that new loads touch, and readers take each quarter from the newest version that has it.

A refresh reads the facts of loads that have no part yet, then the parts of the touched quarters; all other quarters are neither
read nor written. A load that compaction made gets the sum of the parts that it replaces; its quarters stay as they are. A part or
version counts when its write has finished; an unfinished one is written again. Refreshes of one warehouse run one at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import numeric, rules
from tillstar.plans import parts
from tillstar.session import path_exists, remove

PARTS, SAVED, VERSION = "quarter_parts", "saved_quarters", "Version"
_SUMS = ["Sales", "Quantity", "Transactions"]
_PART, _SAVED = schemas.QUARTER_PARTS, schemas.SAVED_QUARTERS
QUARTER = ["Sale_Year", "Quarter"]


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*QUARTER, *keys).agg(*[F.sum(c).cast(_PART[c].dataType).alias(c) for c in _SUMS])


def _of_facts(facts: DataFrame) -> DataFrame:
    month = F.floor(F.col("Date_Key") / 100) % 100
    rows = facts.select(
        "Sale_Year", F.ceil(month / 3).cast("int").alias("Quarter"), "Store_Key", "Customer_Key",
        F.col("Total_Purchase_Amount").alias("Sales"), F.col("Quantity").cast("bigint").alias("Quantity"), F.lit(1).cast("bigint").alias("Transactions"),
    )
    return _added(rows, "Store_Key", "Customer_Key")


def _finished(spark: SparkSession, path: str, names: list[str]) -> set[str]:
    return {n for n in names if path_exists(spark, f"{parts.part_folder(path, n)}/_SUCCESS")}


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions of the saved table, oldest first."""
    found = [int(n) for n in parts.folders(spark, f"{root}/{SAVED}", f"{VERSION}=")]
    return sorted(n for n in found if path_exists(spark, f"{root}/{SAVED}/{VERSION}={n}/_SUCCESS"))


def refresh(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Bring the saved quarters up to date with the facts below ``root``; returns the quarters that were written again."""
    facts, path = f"{root}/fact_sales", f"{root}/{PARTS}"
    loads = parts.visible_loads(spark, facts)
    replaced = parts.replaced_loads(spark, facts)
    done = _finished(spark, path, sorted({*loads, *(old for olds in replaced.values() for old in olds)}))
    new = [n for n in loads if n not in done]
    fresh = []
    for name in new:
        olds = replaced.get(name, [])
        merged = bool(olds) and done.issuperset(olds)
        if merged:
            sums = _added(parts.read_parts(spark, path, _PART, olds), "Store_Key", "Customer_Key")
        else:
            sums = _of_facts(parts.read_parts(spark, facts, schemas.FACT_SALES, [name]))
            fresh.append(name)
        sums.write.mode("overwrite").partitionBy(*QUARTER).parquet(parts.part_folder(path, name))
    if not fresh:
        return []
    touched = parts.read_parts(spark, path, _PART, fresh).select(*QUARTER).distinct()
    quarters = sorted(map(tuple, touched.collect()))  # a row per quarter
    wanted = F.broadcast(spark.createDataFrame(quarters, "Sale_Year int, Quarter int"))
    # the quarters are partition columns, so other quarters' files are not read
    rows = parts.read_parts(spark, path, _PART, loads).join(wanted, QUARTER)
    per_store = _added(rows, "Store_Key", "Customer_Key").groupBy(*QUARTER, "Store_Key").agg(
        *[F.sum(c).cast(_PART[c].dataType).alias(c) for c in _SUMS], F.count(F.lit(1)).alias("Customers")
    )
    known = parts.folders(spark, f"{root}/{SAVED}", f"{VERSION}=")
    version = max(map(int, known), default=0) + 1
    per_store.write.partitionBy(*QUARTER).parquet(f"{root}/{SAVED}/{VERSION}={version}")
    return quarters


def saved(spark: SparkSession, root: str) -> DataFrame:
    """The saved sums of every quarter, from the newest version that has it."""
    path, known = f"{root}/{SAVED}", _versions(spark, root)
    if not known:
        return spark.createDataFrame([], _SAVED)
    rows = spark.read.schema(_SAVED).option("basePath", path).parquet(*[f"{path}/{VERSION}={n}" for n in known])
    newest = rows.groupBy(*QUARTER).agg(F.max(VERSION).alias(VERSION))  # a row per quarter
    return rows.join(F.broadcast(newest), [*QUARTER, VERSION])


def clean(spark: SparkSession, root: str) -> None:
    """Delete versions of which no quarter is the newest."""
    used = {r[0] for r in saved(spark, root).select(VERSION).distinct().collect()}  # a row per version in use
    for n in _versions(spark, root):
        if n not in used:
            remove(spark, f"{root}/{SAVED}/{VERSION}={n}")


def report(spark: SparkSession, root: str, dim_store: DataFrame) -> DataFrame:
    """The quarterly store report from the saved sums."""
    stores = dim_store.select("Store_Key", "Store_ID", "Store_Name")
    return saved(spark, root).join(stores, "Store_Key").select(
        "Store_ID", "Store_Name", F.col("Sale_Year").alias("Year"), "Quarter",
        rules.quarter_label(F.col("Quarter"), F.col("Sale_Year")).alias("Quarter_Label"),
        numeric.as_double(F.col("Sales"), "Quarterly_Sales"), F.col("Quantity").alias("Quarterly_Quantity"),
        F.col("Transactions").alias("Total_Transactions"), F.col("Customers").alias("Unique_Customers"),
        numeric.as_double(numeric.mean(F.col("Sales"), F.col("Transactions")), "Avg_Transaction_Value"),
    ).orderBy("Store_Name", "Year", "Quarter")
