"""A tiny warehouse whose inputs are given row by row."""

import datetime as dt

from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.plans import dims, load
from tillstar.plans.star import Warehouse
from tillstar.session import new_work_folder
from tillstar.sources import readers

TX = "orderID string, Customer_ID string, Product_ID string, quantity string, date string"


def day(text):
    return dt.date.fromisoformat(text)


def customers(spark, rows=None):
    rows = rows or [
        (1, "M", "18-25", 0, "A", "0", 0), (2, "F", "26-35", 12, "B", "2", 1), (3, "F", "26-35", 16, "C", "4+", 0),
        (4, "M", "55+", 5, "D", "1", 1),
    ]
    return spark.createDataFrame(rows, schemas.MASTER_CUSTOMER)


def products(spark, rows=None):
    rows = rows or [
        ("A", "Toys", "10.00", "1", "North", "7", "Acme"), ("B", "Toys", "50.00", "1", "North", "8", "Bolt"),
        ("C", "Food", "70.00", "2", "South", "7", "Acme"), ("D", "Food", "1.00", "2", "South", "8", "Bolt"),
        ("Z", "Food", "0.00", "2", "South", "8", "Bolt"),
    ]
    kinds = "Product_ID string, Product_Category string, Price string, StoreID string, StoreName string, SupplierID string, SupplierName string"
    return spark.createDataFrame(rows, kinds).withColumn("Price", F.col("Price").cast(schemas.PRICE))


def transactions(spark, rows):
    """Rows of (order, customer, product, quantity, date), as text."""
    return readers.clean_transactions(spark.createDataFrame([tuple(map(str, r)) for r in rows], TX))


class SharedDimensions(Warehouse):
    """A warehouse of its own whose dimensions and masters are read from another one."""

    def __init__(self, spark, root, base):
        super().__init__(spark, root)
        self.base = base

    def table(self, name):
        return super().table(name) if name.startswith(("fact_", "stage_")) else self.base.table(name)


_bases = {}


def empty_warehouse(spark, root, customer_rows=None, product_rows=None, years=(2017, 2018)):
    """Equal dimensions are built once per test session."""
    key = repr((spark.sparkContext.applicationId, customer_rows, product_rows, years))
    if key not in _bases:
        base = Warehouse(spark, new_work_folder(spark, "fixture"))
        base.load_masters(customers(spark, customer_rows), products(spark, product_rows))
        base.load_dimensions(dims.years_between(spark, *years))
        _bases[key] = base
    return SharedDimensions(spark, str(root), _bases[key])


def star(spark, root, rows, **kwargs):
    warehouse = empty_warehouse(spark, root, **kwargs)
    warehouse.load_sales(transactions(spark, rows))
    return warehouse.star


def reasons(rejects):
    found = {}
    for r in rejects.collect():
        found[r.Reason] = found.get(r.Reason, 0) + r.Copies
    return found


__all__ = ["load", "star", "empty_warehouse", "transactions", "reasons", "day"]
