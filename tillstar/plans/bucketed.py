"""Facts and customers bucketed by customer, so that reports over all facts meet the customers without a shuffle of facts.

What such reports read of the facts is stored once more, in as many buckets of ``Customer_Key`` as the customers: sums per customer
and the join with the customers then happen where the rows lie, and only sums per attribute of the customer are shuffled.

A bucket is read by one task. Customers with very many facts are therefore kept apart, in a table without buckets, whose sums
combine before the shuffle as ever (fewer than ``skew.HOT_SHARE`` customers). The two parts hold different customers, so
sums and numbers of customers add up (``summary.roll_up``).

A copy is named by the loads that it was made from: after a load, or a compaction, it is not found any more and made anew.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstar.operators.skew import HOT_MIN_ROWS, hot_keys
from tillstar.plans import parts
from tillstar.plans.star import Star, Warehouse
from tillstar.session import estimated_bytes, path_exists, remove, stored

KEY = "Customer_Key"
COLUMNS = (KEY, "Product_Key", "Store_Key", "Supplier_Key", "Quantity", "Total_Purchase_Amount")
BUCKET_BYTES = 256 * 2**20
LEAST_BUCKETS = 8
HOT_ROWS = HOT_MIN_ROWS


def _version(w: Warehouse) -> str:
    loads = parts.visible_loads(w.spark, f"{w.root}/fact_sales")
    return hashlib.md5("\n".join(loads).encode()).hexdigest()


def current(w: Warehouse) -> str | None:
    """The finished copy of the facts as they are: its folder's name, which ends with the number of buckets."""
    found = [_version(w) + rest for rest in parts.folders(w.spark, f"{w.root}/bucketed", _version(w))]
    return next((name for name in found if path_exists(w.spark, f"{w.root}/bucketed/{name}/hot/_SUCCESS")), None)


def _table_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    """One file per bucket. The catalog's entry is external: dropping it leaves the files."""
    name = _table_name(path)
    rows.sparkSession.sql(f"drop table if exists {name}")
    dealt = rows.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
    dealt.option("path", path).mode("overwrite").saveAsTable(name)


def _read(spark: SparkSession, path: str, buckets: int, layout: StructType) -> DataFrame:
    """A bucketed folder; it is entered into the catalog of a session that does not know it."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout)
        spark.sql(f"create table {name} ({columns}) using parquet clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets location '{path}'")
    spark.catalog.refreshTable(name)  # another session may have written the folder anew
    return spark.table(name)


def build(w: Warehouse) -> str:
    """Store facts and customers by bucket, unless that is done; returns the name of the copy."""
    if found := current(w):
        return found
    facts = w.star.fact_sales.select(*COLUMNS)
    buckets = max(LEAST_BUCKETS, -(-estimated_bytes(facts) // BUCKET_BYTES))
    name = f"{_version(w)}-{buckets}"
    path = f"{w.root}/bucketed/{name}"
    hot = F.broadcast(stored(hot_keys(facts, [KEY], min_rows=HOT_ROWS).select(KEY), "hot_customers"))
    _write(facts.join(hot, KEY, "left_anti"), f"{path}/facts", buckets)
    _write(w.star.dim_customer, f"{path}/customers", buckets)
    facts.join(hot, KEY, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")  # the last one: it marks the copy as whole
    return name


def star(w: Warehouse) -> Star:
    """The star with facts and customers by bucket."""
    name = build(w)
    buckets = int(name.rpartition("-")[2])
    path = f"{w.root}/bucketed/{name}"
    layout = w.star.fact_sales.select(*COLUMNS).schema
    hot = w.spark.read.schema(layout).parquet(f"{path}/hot")
    cold = _read(w.spark, f"{path}/facts", buckets, layout)
    customers = _read(w.spark, f"{path}/customers", buckets, w.star.dim_customer.schema)
    return replace(w.star, dim_customer=customers, fact_parts=(cold,) if hot.isEmpty() else (cold, hot))


def clean(w: Warehouse) -> None:
    """Delete copies of facts that are out of date; not while reports run on them."""
    kept = current(w)
    for name in parts.folders(w.spark, f"{w.root}/bucketed", ""):
        if name != kept:
            for table in ("facts", "customers"):
                w.spark.sql(f"drop table if exists {_table_name(f'{w.root}/bucketed/{name}/{table}')}")
            remove(w.spark, f"{w.root}/bucketed/{name}")
