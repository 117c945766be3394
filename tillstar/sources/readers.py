"""Raw inputs: CSV files read as text, then cleaned into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names a blank index header gets, and the priced column's raw name.
INDEX_COLUMNS = ["Unnamed: 0", "_c0"]
RAW_PRICE_COLUMN = "price$"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text; types are applied by name afterwards, never inferred."""
    return spark.read.option("header", True).csv(path)


def drop_index_column(raw: DataFrame) -> DataFrame:
    return raw.drop(*INDEX_COLUMNS)


def clean_customers(raw: DataFrame) -> DataFrame:
    return drop_index_column(raw).select(
        F.col("Customer_ID").try_cast("bigint").alias("Customer_ID"),
        F.col("Gender").cast("string").alias("Gender"),
        F.col("Age").cast("string").alias("Age"),
        F.col("Occupation").try_cast("int").alias("Occupation"),
        F.col("City_Category").cast("string").alias("City_Category"),
        F.col("Stay_In_Current_City_Years").cast("string").alias("Stay_In_Current_City_Years"),
        F.col("Marital_Status").try_cast("int").alias("Marital_Status"),
    )


def clean_products(raw: DataFrame) -> DataFrame:
    named = drop_index_column(raw).withColumnRenamed(RAW_PRICE_COLUMN, "price")
    return named.select(
        F.col("Product_ID").cast("string").alias("Product_ID"),
        F.col("Product_Category").cast("string").alias("Product_Category"),
        F.col("price").try_cast("decimal(10,2)").alias("Price"),
        F.col("storeID").cast("string").alias("StoreID"),
        F.col("storeName").cast("string").alias("StoreName"),
        F.col("supplierID").cast("string").alias("SupplierID"),
        F.col("supplierName").cast("string").alias("SupplierName"),
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Order, customer, product, quantity and date by position, plus ``Arrival`` and ``Unparsable``.

    ``Arrival`` orders rows that share a fact key: the columns after the fifth when the source
    has them, otherwise the remaining values of the row.
    """
    rows = drop_index_column(raw)
    order, customer, product, quantity, day = (F.col(f"`{c}`") for c in rows.columns[:5])
    typed = {
        "Order_ID": order.try_cast("bigint"),
        "Customer_ID": customer.try_cast("bigint"),
        "Product_ID": product.cast("string"),
        "Quantity": quantity.try_cast("int"),
        "Sale_Date": day.try_cast("date"),
    }
    extra = rows.columns[5:]
    arrival = F.struct(*extra) if extra else F.struct(typed["Quantity"].alias("q"), typed["Customer_ID"].alias("c"))
    return rows.select(*[value.alias(name) for name, value in typed.items()], arrival.alias("Arrival")).withColumn(
        "Unparsable", any_null(*typed)
    )


def any_null(*names: str) -> Column:
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    return missing
