"""Data-quality reports. Each returns a small DataFrame; key comparisons work on distinct keys, so a
key with very many rows has collapsed before anything is joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.plans.star import Star

EXAMPLES = 5


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [df.agg(F.count(F.lit(1)).alias("Row_Count")).select(F.lit(name).alias("Table_Name"), "Row_Count")
         for name, df in tables.items()]
    )


def key_uniqueness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, distinct keys, keys that repeat, and whether the key is unique."""

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        repeated = F.count_if((F.col("n") > 1) & F.col(key).isNotNull())
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("Total_Rows"),
            F.count(key).alias("Distinct_Keys"),
            repeated.alias("Repeated_Keys"),
        ).select(
            F.lit(name).alias("Table_Name"), F.lit(key).alias("Key_Column"), "Total_Rows", "Distinct_Keys",
            "Repeated_Keys", (F.col("Repeated_Keys") == 0).cast("int").alias("Is_Unique"),
        )

    return _union([one(name, df, key) for name, (df, key) in tables.items()])


def orphans(transactions: DataFrame, master: DataFrame, key: str, examples: int = EXAMPLES) -> DataFrame:
    """Number of distinct transaction keys without a master row, and the smallest of them."""
    missing = transactions.select(key).where(F.col(key).isNotNull()).distinct().join(
        master.select(key), key, "left_anti"
    )
    total = missing.agg(F.count(F.lit(1)).cast("string").alias("Value")).select(
        F.lit("orphan_keys").alias("Measure"), "Value"
    )
    first = missing.orderBy(key).limit(examples).select(
        F.lit("example").alias("Measure"), F.col(key).cast("string").alias("Value")
    )
    return total.unionByName(first)


def reconciliation(transactions: DataFrame, enriched: DataFrame) -> DataFrame:
    before = transactions.agg(F.count(F.lit(1)).alias("Rows_Before"))
    after = enriched.agg(F.count(F.lit(1)))
    return before.select("Rows_Before", after.scalar().alias("Rows_After")).withColumn(
        "Rows_Lost", F.col("Rows_Before") - F.col("Rows_After")
    )


def non_null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Type and number of values of every column; one pass per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
        lines = F.array(*[
            F.struct(
                F.lit(c).alias("Column_Name"), F.lit(kind).alias("Data_Type"), F.col(c).alias("Non_Null_Count")
            )
            for c, kind in df.dtypes
        ])
        return counted.select(F.lit(name).alias("Table_Name"), F.inline(lines))

    return _union([one(name, df) for name, df in tables.items()])


FOREIGN_KEYS = {
    "Customer_Key": "dim_customer", "Product_Key": "dim_product", "Store_Key": "dim_store",
    "Supplier_Key": "dim_supplier", "Date_Key": "dim_date",
}


def foreign_key_violations(star: Star) -> DataFrame:
    """Fact rows, and distinct keys, whose key has no row in the dimension; NULL is such a key.

    One pass over the facts: all keys of a row are counted as (name, key), which combines before the shuffle.
    """
    pair = lambda name: F.struct(F.lit(name).alias("Foreign_Key"), F.col(name).cast("bigint").alias("key"))
    keys = star.fact_sales.select(F.inline(F.array(*[pair(name) for name in FOREIGN_KEYS])))
    counts = keys.groupBy("Foreign_Key", "key").agg(F.count(F.lit(1)).alias("n"))
    known = _union([getattr(star, table).select(pair(name).alias("k")).select("k.*") for name, table in FOREIGN_KEYS.items()])
    missing = counts.join(known, ["Foreign_Key", "key"], "left_anti").groupBy("Foreign_Key").agg(
        F.count(F.lit(1)).alias("Missing_Keys"), F.sum("n").alias("Fact_Rows")
    )
    names = star.fact_sales.sparkSession.createDataFrame([(name,) for name in FOREIGN_KEYS], "Foreign_Key string")
    zero = F.lit(0).cast("bigint")
    return names.join(missing, "Foreign_Key", "left").select(
        "Foreign_Key", F.coalesce("Missing_Keys", zero).alias("Missing_Keys"), F.coalesce("Fact_Rows", zero).alias("Fact_Rows")
    )


def constraint_violations(tables: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Rows that break each rule; all rules of a table are counted in one pass."""

    def one(name: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
        counted = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
        lines = F.array(*[F.struct(F.lit(r).alias("Rule"), F.col(f"`{r}`").alias("Violations")) for r in rules])
        return counted.select(F.lit(name).alias("Table_Name"), F.inline(lines))

    return _union([one(name, df, rules) for name, (df, rules) in tables.items()])


def not_null_rules(*columns: str) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNull() for c in columns}


def positive_rule(column: str) -> dict[str, Column]:
    return {f"{column} > 0": F.col(column) <= 0}


def multi_product_orders(sales: DataFrame, order: str = "Order_ID", product: str = "Product_Key") -> DataFrame:
    return (
        sales.groupBy(order)
        .agg(F.count_distinct(product).alias("Product_Count"))
        .where(F.col("Product_Count") > 1)
    )
