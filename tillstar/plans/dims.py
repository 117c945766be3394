"""The five dimensions and the two master relations."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import numeric, rules
from tillstar.operators.dedupe import first_by_minimum
from tillstar.operators.keys import read_with_dense_key, write_sorted
from tillstar.session import write_if_empty


# --- calendar ---------------------------------------------------------------
def years_between(spark: SparkSession, first: int = 2015, last: int = 2020) -> DataFrame:
    return spark.range(1).select(F.lit(first).alias("First_Year"), F.lit(last).alias("Last_Year"))


def years_of(days: DataFrame, column: str, last: int | None = None) -> DataFrame:
    """Whole years that cover the dates of a table; ``last`` ends the calendar earlier."""
    bounds = days.agg(F.year(F.min(column)).alias("First_Year"), F.year(F.max(column)).alias("Last_Year"))
    if last is not None:
        bounds = bounds.withColumn("Last_Year", F.least("Last_Year", F.lit(last)))
    return bounds


def dim_date(years: DataFrame) -> DataFrame:
    """One row per day from 1 January of the first to 31 December of the last year."""
    day, month = F.col("Full_Date"), F.month("Full_Date")
    days = years.where("First_Year is not null").select(
        F.explode(
            F.sequence(
                F.make_date("First_Year", F.lit(1), F.lit(1)), F.make_date("Last_Year", F.lit(12), F.lit(31))
            )
        ).alias("Full_Date")
    )
    return _typed(
        days,
        schemas.DIM_DATE,
        Date_Key=rules.date_key(day),
        Day_Of_Week=F.date_format(day, "EEEE"),
        Day_Name=F.date_format(day, "EEEE"),
        Is_Weekend=rules.is_weekend(day),
        Day_Of_Month=F.dayofmonth(day),
        Day_Of_Year=F.dayofyear(day),
        Week_Number=F.weekofyear(day),
        Month=month,
        Month_Name=F.date_format(day, "MMMM"),
        Quarter=F.quarter(day),
        Quarter_Label=F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        Half_Year=rules.half_year(day),
        Year=F.year(day),
        Season=rules.season(month),
        Fiscal_Month=rules.fiscal_month(month),
        Fiscal_Quarter=rules.fiscal_quarter(month),
        Fiscal_Year=rules.fiscal_year(day),
    )


# --- customer and product ---------------------------------------------------
def unique_master(cleaned: DataFrame, key: str) -> DataFrame:
    """One row per natural key; rows without a key cannot be looked up and are left out."""
    others = [c for c in cleaned.columns if c != key]
    packed = cleaned.where(F.col(key).isNotNull()).select(key, F.struct(*others).alias("_row"))
    return first_by_minimum(packed, [key], "_row").select(key, "_row.*")


def dim_customer(master: DataFrame) -> DataFrame:
    stay, marital, city = (F.col(c) for c in ("Stay_In_Current_City_Years", "Marital_Status", "City_Category"))
    return _typed(
        master,
        schemas.DIM_CUSTOMER,
        Occupation_Bucket=rules.occupation_bucket(F.col("Occupation")),
        City_Tier=rules.city_tier(city),
        Stay_Bucket=rules.stay_bucket(stay),
        Marital_Status_Label=rules.marital_label(marital),
        Loyalty_Segment=rules.loyalty_segment(stay, marital),
    )


def dim_product(master: DataFrame) -> DataFrame:
    price = F.col("Price")
    return _typed(
        master,
        schemas.DIM_PRODUCT,
        Unit_Price=price,
        Price_Band=rules.price_band(price),
        Is_Premium=rules.is_premium(price),
    )


# --- store and supplier, derived from the product master ----------------------
def _by_category(products: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Product rows per group and category: the first of two aggregation steps, so that distinct
    categories and the most frequent category need no second look at the products."""
    complete = products
    for source in keys:
        complete = complete.where(F.col(source).isNotNull())
    return complete.groupBy(*[F.col(s).alias(t) for s, t in keys.items()], "Product_Category").agg(
        F.count("Product_ID").alias("_skus"), F.sum("Price").alias("_price"), F.count("Price").alias("_priced")
    )


def _average_price() -> Column:
    return numeric.mean(F.sum("_price"), F.sum("_priced"), 2).cast("decimal(10,2)").alias("Avg_List_Price")


def stores(products: DataFrame) -> DataFrame:
    grouped = (
        _by_category(products, {"StoreID": "Store_ID", "StoreName": "Store_Name"})
        .groupBy("Store_ID", "Store_Name")
        .agg(
            F.sum("_skus").alias("SKU_Count"),
            F.count("Product_Category").alias("Category_Count"),
            _average_price(),
        )
    )
    return unique_master(grouped, "Store_ID")


def dim_store(grouped: DataFrame) -> DataFrame:
    return _typed(
        grouped,
        schemas.DIM_STORE,
        Store_Channel=F.lit(rules.STORE_CHANNEL),
        Store_Tier=rules.store_tier(F.col("SKU_Count")),
        Is_Flagship=rules.is_flagship(F.col("SKU_Count"), F.col("Avg_List_Price")),
        Is_Active=F.lit(1),
    )


def suppliers(products: DataFrame) -> DataFrame:
    """The main category is the one with most product rows, on a tie the first by name."""
    named = F.when(F.col("Product_Category").isNotNull(), F.struct(-F.col("_skus"), "Product_Category"))
    grouped = (
        _by_category(products, {"SupplierID": "Supplier_ID", "SupplierName": "Supplier_Name"})
        .groupBy("Supplier_ID", "Supplier_Name")
        .agg(
            F.min(named).getField("Product_Category").alias("Primary_Category"),
            F.sum("_skus").alias("SKU_Count"),
            _average_price(),
        )
    )
    return unique_master(grouped, "Supplier_ID")


def dim_supplier(grouped: DataFrame) -> DataFrame:
    return _typed(
        grouped,
        schemas.DIM_SUPPLIER,
        Supplier_Tier=rules.supplier_tier(F.col("SKU_Count")),
        Reliability_Score=F.lit(None),
    )


# --- storing ----------------------------------------------------------------
_KEYED = {
    # table: (natural key, surrogate key, attribute builder)
    "dim_customer": ("Customer_ID", "Customer_Key", dim_customer),
    "dim_product": ("Product_ID", "Product_Key", dim_product),
    "dim_store": ("Store_ID", "Store_Key", dim_store),
    "dim_supplier": ("Supplier_ID", "Supplier_Key", dim_supplier),
}


def store_masters(customers: DataFrame, products: DataFrame, root: str) -> None:
    """Sorted master relations; those that hold rows stay as they are."""
    together(
        lambda: write_sorted(unique_master(customers, "Customer_ID"), "Customer_ID", f"{root}/master_customer"),
        lambda: write_sorted(unique_master(products, "Product_ID"), "Product_ID", f"{root}/master_product"),
    )


def store_dimensions(spark: SparkSession, root: str, years: DataFrame) -> None:
    """Build the five dimensions from the stored masters, unless they hold rows; independent tables side by side."""
    products = spark.read.parquet(f"{root}/master_product")
    together(
        lambda: write_if_empty(dim_date(years).coalesce(1), f"{root}/dim_date"),
        lambda: write_sorted(stores(products), "Store_ID", f"{root}/grouped_store"),
        lambda: write_sorted(suppliers(products), "Supplier_ID", f"{root}/grouped_supplier"),
        lambda: load_dimension(spark, f"{root}/master_customer", "dim_customer", f"{root}/dim_customer"),
        lambda: load_dimension(spark, f"{root}/master_product", "dim_product", f"{root}/dim_product"),
    )
    together(
        lambda: load_dimension(spark, f"{root}/grouped_store", "dim_store", f"{root}/dim_store"),
        lambda: load_dimension(spark, f"{root}/grouped_supplier", "dim_supplier", f"{root}/dim_supplier"),
    )


def together(*writes: Callable[[], object]) -> list[object]:
    """Submit independent Spark jobs at the same time, wait for all of them and return what they give."""
    with ThreadPoolExecutor(len(writes)) as pool:
        return [done.result() for done in [pool.submit(write) for write in writes]]


def load_dimension(spark: SparkSession, source: str, table: str, target: str) -> None:
    if table not in _KEYED:
        raise ValueError(f"unknown dimension table: {table}")
    natural, surrogate, build = _KEYED[table]
    write_if_empty(build(read_with_dense_key(spark, source, natural, surrogate)), target)


def key_lookup(dimension: DataFrame, table: str) -> DataFrame:
    """The pair (natural key, surrogate key); a date is its own key."""
    if table == "dim_date":
        return dimension.select("Full_Date", "Date_Key")
    natural, surrogate, _ = _KEYED[table]
    return dimension.select(natural, surrogate)


def _typed(df: DataFrame, layout, **derived: Column) -> DataFrame:
    """Columns of ``layout`` in order: derived ones, else the frame's own, cast to the declared type."""
    return df.select(
        *[derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in layout.fields]
    )
