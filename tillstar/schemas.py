"""Table layouts of the warehouse.

Surrogate keys are BIGINT: a dense INT key runs out at 2.1 billion members.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tillstar.session import remove, write_if_empty

PRICE = DecimalType(10, 2)
AMOUNT = DecimalType(12, 2)


def _columns(required: str, **kinds) -> StructType:
    needed = set(required.split())
    return StructType([StructField(n, k, n not in needed) for n, k in kinds.items()])


_s, _i, _l, _d = StringType(), IntegerType(), LongType(), DateType()

MASTER_CUSTOMER = _columns(
    "Customer_ID",
    Customer_ID=_l, Gender=_s, Age=_s, Occupation=_i, City_Category=_s,
    Stay_In_Current_City_Years=_s, Marital_Status=_i,
)

MASTER_PRODUCT = _columns(
    "Product_ID",
    Product_ID=_s, Product_Category=_s, Price=PRICE, StoreID=_s, StoreName=_s,
    SupplierID=_s, SupplierName=_s,
)

# Raw files carry text; sources.readers casts it.
RAW_TRANSACTION_FIELDS = ["orderID", "Customer_ID", "Product_ID", "quantity", "date"]
RAW_TRANSACTION = StructType([StructField(n, _s) for n in RAW_TRANSACTION_FIELDS])

DIM_DATE = _columns(
    "Date_Key Full_Date",
    Date_Key=_i, Full_Date=_d, Day_Of_Week=_s, Day_Name=_s, Is_Weekend=_i, Day_Of_Month=_i,
    Day_Of_Year=_i, Week_Number=_i, Month=_i, Month_Name=_s, Quarter=_i, Quarter_Label=_s,
    Half_Year=_s, Year=_i, Season=_s, Fiscal_Month=_i, Fiscal_Quarter=_s, Fiscal_Year=_i,
)

DIM_CUSTOMER = _columns(
    "Customer_Key Customer_ID",
    Customer_Key=_l, Customer_ID=_l, Gender=_s, Age=_s, Occupation=_i, Occupation_Bucket=_s,
    City_Category=_s, City_Tier=_s, Stay_In_Current_City_Years=_s, Stay_Bucket=_s,
    Marital_Status=_i, Marital_Status_Label=_s, Loyalty_Segment=_s,
)

DIM_PRODUCT = _columns(
    "Product_Key Product_ID",
    Product_Key=_l, Product_ID=_s, Product_Category=_s, Unit_Price=PRICE, Price_Band=_s, Is_Premium=_i,
)

DIM_STORE = _columns(
    "Store_Key Store_ID",
    Store_Key=_l, Store_ID=_s, Store_Name=_s, Store_Channel=_s, Store_Tier=_s, SKU_Count=_l,
    Category_Count=_l, Avg_List_Price=PRICE, Is_Flagship=_i, Is_Active=_i,
)

DIM_SUPPLIER = _columns(
    "Supplier_Key Supplier_ID",
    Supplier_Key=_l, Supplier_ID=_s, Supplier_Name=_s, Supplier_Tier=_s, Primary_Category=_s,
    SKU_Count=_l, Avg_List_Price=PRICE, Reliability_Score=DecimalType(5, 2),
)

# Source_Rows counts the input rows that share the fact's unique key; Sale_Year is the partition column.
FACT_SALES = _columns(
    "Order_ID Customer_Key Product_Key Store_Key Supplier_Key Date_Key Quantity Unit_Price Total_Purchase_Amount",
    Sales_Key=_l, Order_ID=_l, Order_Line_Number=_i, Customer_Key=_l, Product_Key=_l, Store_Key=_l,
    Supplier_Key=_l, Date_Key=_i, Quantity=_i, Unit_Price=PRICE, Total_Purchase_Amount=AMOUNT,
    Discount_Amount=AMOUNT, Net_Sales_Amount=AMOUNT, Weekend_Flag=_i, Order_Channel=_s,
    Created_At=TimestampType(), Source_Rows=_l, Sale_Year=_i,
)

FACT_UNIQUE_KEY = ["Order_ID", "Product_Key", "Date_Key"]

FACT_REJECTS = _columns(
    "Reason",
    Order_ID=_l, Customer_ID=_l, Product_ID=_s, Quantity=_i, Sale_Date=_d, Reason=_s, Copies=_l,
)

# What a load counted, and the sums that the quarterly report is saved as.
_SUM = DecimalType(38, 2)
LOAD_AUDIT = _columns("", streamed=_l, customer=_l, product=_l, loaded=_l)
QUARTER_PARTS = _columns("", Store_Key=_l, Customer_Key=_l, Sales=_SUM, Quantity=_l, Transactions=_l, Sale_Year=_i, Quarter=_i)
SAVED_QUARTERS = _columns(
    "", Store_Key=_l, Sales=_SUM, Quantity=_l, Transactions=_l, Customers=_l, Sale_Year=_i, Quarter=_i, Version=_i,
)

STAR_TABLES = {
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_store": DIM_STORE,
    "dim_supplier": DIM_SUPPLIER,
    "fact_sales": FACT_SALES,
}
MASTER_TABLES = {"master_customer": MASTER_CUSTOMER, "master_product": MASTER_PRODUCT}


#: What is kept beside the facts of a warehouse and made from them; ``recreate_tables`` and a rebuild drop it.
DERIVED = ("load_audit", "quarter_parts", "saved_quarters", "bucketed")
IDENTITY = "warehouse_id"


def warehouse_id(spark: SparkSession, root: str) -> str:
    """Names the facts below ``root`` from their first load, or creation, until they are dropped."""
    path = f"{root}/{IDENTITY}"
    write_if_empty(spark.createDataFrame([(uuid.uuid4().hex,)], "id string").coalesce(1), path)
    return spark.read.parquet(path).first()[0]


def drop_loads(spark: SparkSession, root: str) -> None:
    """Drop facts and rejects, all that is made from them, and the stream's checkpoint, which says what is loaded."""
    for name in ("fact_sales", "fact_rejects", "stage_sales", "stage_repeated", *DERIVED, "checkpoint", IDENTITY):
        remove(spark, f"{root}/{name}")


def recreate_tables(spark: SparkSession, root: str) -> None:
    """Drop and create every warehouse table, empty, below ``root``; a stream starts from its first file again."""
    drop_loads(spark, root)
    for name in ("grouped_store", "grouped_supplier", "product_keys"):
        remove(spark, f"{root}/{name}")
    for name, layout in {**STAR_TABLES, **MASTER_TABLES}.items():
        writer = spark.createDataFrame([], layout).write.mode("overwrite")
        if name == "fact_sales":
            # an empty partitioned write leaves no file, so readers always pass the schema
            writer = writer.partitionBy("Sale_Year")
        writer.parquet(f"{root}/{name}")
