"""Binds the order tables (customer, supplier, part, orders, lineitem) to the three raw retail inputs.

The expressions are SQL text that Spark and a reference SQL engine read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import as_lookup

CUSTOMER_BINDING = {
    "Customer_ID": "cast(c_custkey as bigint)",
    "Gender": "case when c_custkey % 2 = 0 then 'M' else 'F' end",
    "Age": "case c_mktsegment when 'AUTOMOBILE' then '18-25' when 'BUILDING' then '26-35' "
           "when 'FURNITURE' then '36-45' when 'HOUSEHOLD' then '46-55' when 'MACHINERY' then '55+' "
           "else '0-17' end",
    "Occupation": "cast(c_custkey % 21 as int)",
    "City_Category": "case c_nationkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'C' else 'D' end",
    "Stay_In_Current_City_Years": "case when c_custkey % 5 = 4 then '4+' else cast(c_custkey % 5 as varchar(2)) end",
    "Marital_Status": "case when c_custkey % 3 = 0 then 1 else 0 end",
}

# twelve digits: string order equals numeric order up to a trillion parts
PRODUCT_ID = "concat('P', lpad(cast({key} as varchar(20)), 12, '0'))"

PRODUCT_BINDING = {
    "Product_ID": PRODUCT_ID.format(key="p_partkey"),
    "Product_Category": "p_type",
    "price": "cast(cast(p_retailprice as decimal(10,2)) - 900 as decimal(10,2))",
    "storeID": "case when p_partkey % 100 < 40 then 1 when p_partkey % 100 < 60 then 2 else 3 + p_partkey % 6 end",
    "supplierID": "case when p_partkey % 20 < 7 then 1 when p_partkey % 20 < 10 then 2 else 3 + p_partkey % 5 end",
}

TRANSACTION_BINDING = {
    "orderID": "l_orderkey",
    "Customer_ID": "o_custkey",
    "Product_ID": PRODUCT_ID.format(key="l_partkey"),
    "quantity": "cast(l_quantity as int)",
    "date": "cast(o_orderdate as date)",
}
# total among the lines of one order and product
TRANSACTION_ORDER = ["l_linenumber", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice"]

# Raw rows that are added to the whole tables, so that every reason to reject a row occurs: lines that come
# once more with something wrong, and products that cannot be sold. All are derived from the given tables.
FAULTY_LINES = [
    ("l_linenumber = 1 and l_orderkey % 50 = 1", {"Customer_ID": "-1 - o_custkey"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 2", {"Product_ID": "concat('X', cast(l_partkey as varchar(20)))"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 3", {"Product_ID": "'NO STORE'"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 4", {"Product_ID": "'NO SUPPLIER'"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 5", {"date": "cast('1900-01-01' as date)"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 6", {"quantity": "0"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 7", {"Product_ID": "'NO PRICE'"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 8", {"Product_ID": "'DEAR'", "quantity": "2000000000"}),
    ("l_linenumber = 1 and l_orderkey % 50 = 9", {"quantity": "cast(null as int)"}),
]
FAULTY_PRODUCTS = [
    {"Product_ID": "'NO STORE'", "storeID": "cast(null as int)"},
    {"Product_ID": "'NO SUPPLIER'", "supplierID": "cast(null as int)"},
    {"Product_ID": "'NO PRICE'", "price": "cast(null as decimal(10,2))"},
    {"Product_ID": "'DEAR'", "price": "cast(9999.99 as decimal(10,2))"},
]
FAULTY_PRODUCT_MODEL = "p_partkey = 1"  # they are like this one otherwise
UNREADABLE = "many"  # the text of a quantity that is no number

# Lines that a later file repeats.
LATE_LINES = "l_orderkey % 97 = 3"


def _select(binding: dict[str, str]) -> list[str]:
    return [f"{text} as `{name}`" for name, text in binding.items()]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(*_select(CUSTOMER_BINDING))


def raw_products(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    """As the file would come: with an index column and the price under its raw name."""
    rows = _table(spark, sf_dir, "part")
    bound = rows.selectExpr("p_partkey as `_c0`", *_select(PRODUCT_BINDING))
    if faulty:
        for wrong in FAULTY_PRODUCTS:
            bound = bound.union(rows.where(FAULTY_PRODUCT_MODEL).selectExpr("p_partkey as `_c0`", *_select({**PRODUCT_BINDING, **wrong})))
    suppliers = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplierID"), F.col("s_name").alias("supplierName")
    )
    return (
        bound.withColumn("storeName", F.concat(F.lit("Store "), F.col("storeID").cast("string")))
        .join(suppliers, "supplierID", "left")
        .withColumnRenamed("price", "price$")
    )


def _lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if partitions:
        lines = lines.repartition(partitions, "l_orderkey")
        orders = orders.repartition(partitions, "o_orderkey").hint("shuffle_hash")
    else:
        orders = as_lookup(orders)
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def raw_transactions(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """With ``partitions``, dealt by order into so many: the lines of an order lie together, behind the shuffle that joins them."""
    return _lines(spark, sf_dir, partitions).selectExpr(*_select(TRANSACTION_BINDING), *TRANSACTION_ORDER)


def late_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).where(LATE_LINES).selectExpr(*_select(TRANSACTION_BINDING), *TRANSACTION_ORDER)


def faulty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The added lines only, as text like a file has it."""
    lines = _lines(spark, sf_dir)
    parts = [lines.where(f).selectExpr(*_select({**TRANSACTION_BINDING, **wrong}), *TRANSACTION_ORDER) for f, wrong in FAULTY_LINES]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    text = [F.coalesce(F.col(c).cast("string"), F.lit(UNREADABLE)).alias(c) for c in TRANSACTION_BINDING]
    return rows.select(*text, *TRANSACTION_ORDER)
