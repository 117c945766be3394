"""From cleaned transactions to facts and rejects.

Every input row ends as one fact or in one reject row: the number of facts plus the sum of the
rejects' ``Copies`` is the number of input rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import numeric, rules
from tillstar.operators.dedupe import first_by_minimum, keep_first, repeated_keys, surplus_rows
from tillstar.plans.parts import PART, part_folder, read_parts
from tillstar.session import COMPRESSION, as_lookup, broadcast_limit, estimated_bytes, fits_broadcast, stored

UNPARSABLE, NO_CUSTOMER, NO_PRODUCT, NO_STORE, NO_SUPPLIER, BAD_DATE, BAD_QUANTITY, NO_PRICE, BAD_AMOUNT, DUPLICATE = (
    "unparsable",
    "customer_not_found",
    "product_not_found",
    "store_not_found",
    "supplier_not_found",
    "date_out_of_calendar",
    "quantity_not_positive",
    "price_missing",
    "amount_out_of_range",
    "duplicate",
)

SEEN_BYTES = 3 * 2**20  # of stored keys, estimated at about 4 bytes each, that a task holds in memory
SLICES, KEY_BYTES = 64, 32  # of all keys; of one key in memory
REPEATED_BYTES = 8 * 2**20  # of hashes of lines that occur again, 8 bytes each, that are broadcast

REJECT_COLUMNS = ["Order_ID", "Customer_ID", "Product_ID", "Quantity", "Sale_Date"]


# --- enrichment with the natural-key masters ----------------------------------
def enrich_customer(transactions: DataFrame, master_customer: DataFrame) -> DataFrame:
    """Inner join; an unmatched transaction is not emitted. No broadcast hint: Spark broadcasts the
    master while it is small and otherwise joins by shuffle, splitting skewed customers at run time."""
    return transactions.join(as_lookup(master_customer), "Customer_ID")


def enrich_product(transactions: DataFrame, master_product: DataFrame) -> DataFrame:
    return transactions.join(as_lookup(master_product), "Product_ID")


def enriched_sales(transactions: DataFrame, master_customer: DataFrame, master_product: DataFrame) -> DataFrame:
    both = enrich_product(enrich_customer(transactions, master_customer), master_product)
    return both.withColumn("Total_Purchase", rules.purchase_amount(F.col("Quantity"), F.col("Price")))


# --- surrogate keys -----------------------------------------------------------
def customer_keys(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select("Customer_ID", "Customer_Key")


def product_keys(
    master_product: DataFrame, dim_product: DataFrame, dim_store: DataFrame, dim_supplier: DataFrame
) -> DataFrame:
    """Everything a sale takes from its product, joined once at product size instead of at fact size."""
    return (
        master_product.select("Product_ID", "Price", F.col("StoreID").alias("Store_ID"), F.col("SupplierID").alias("Supplier_ID"))
        .join(dim_product.select("Product_ID", "Product_Key"), "Product_ID", "left")
        .join(dim_store.select("Store_ID", "Store_Key"), "Store_ID", "left")
        .join(dim_supplier.select("Supplier_ID", "Supplier_Key"), "Supplier_ID", "left")
        .drop("Store_ID", "Supplier_ID")
    )


def without_idle_arrivals(transactions: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Transactions with ``Arrival`` only where lines share order, product and date, and what was written for it.

    It decides between such lines alone, and is the widest part of a row, so no other row takes it through the shuffles. They
    are found by a hash of the three, the only thing that is shuffled here; two lines of one hash by chance just keep it. With
    too many of them to broadcast all rows keep it.
    """
    line = transactions.withColumn("_line", F.xxhash64("Order_ID", "Product_ID", "Sale_Date"))
    repeated = stored(repeated_keys(line, ["_line"]).select("_line"), "repeated_lines")
    if broadcast_limit(transactions.sparkSession) < 0 or estimated_bytes(repeated) > REPEATED_BYTES:
        return transactions, [repeated]
    found = line.join(F.broadcast(repeated.withColumn("_again", F.lit(True))), "_line", "left")
    return found.withColumn("Arrival", F.when(F.col("_again"), F.col("Arrival"))).select(*transactions.columns), [repeated]


def resolve(transactions: DataFrame, customers: DataFrame, products: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Adds surrogate keys (NULL when missing) and ``Reason`` (NULL when the row is loadable)."""
    calendar = F.broadcast(dim_date.select(F.col("Full_Date").alias("Sale_Date"), "Date_Key"))  # a row per day
    keyed = (
        transactions.join(as_lookup(customers), "Customer_ID", "left")
        .join(as_lookup(products), "Product_ID", "left")
        .join(calendar, "Sale_Date", "left")  # last, so that no shuffle carries its column
    )
    return keyed.withColumn("Reason", _first_reason())


def _first_reason() -> Column:
    return (
        F.when(F.col("Unparsable"), UNPARSABLE)
        .when(F.col("Customer_Key").isNull(), NO_CUSTOMER)
        .when(F.col("Product_Key").isNull(), NO_PRODUCT)
        .when(F.col("Store_Key").isNull(), NO_STORE)
        .when(F.col("Supplier_Key").isNull(), NO_SUPPLIER)
        .when(F.col("Date_Key").isNull(), BAD_DATE)
        .when(F.col("Quantity") <= 0, BAD_QUANTITY)
        .when(F.col("Price").isNull(), NO_PRICE)
        .when(rules.purchase_amount(F.col("Quantity"), F.col("Price")).isNull(), BAD_AMOUNT)
    )


def loadable(resolved: DataFrame) -> DataFrame:
    return resolved.where("Reason is null").drop("Reason", "Unparsable")


# --- facts --------------------------------------------------------------------
_FACT_INPUTS = [
    *schemas.FACT_UNIQUE_KEY, "Arrival", "Quantity", "Customer_Key", "Store_Key", "Supplier_Key", "Price", "Sale_Date",
    "Customer_ID", "Product_ID",  # for rejects
]


def repeated_sales(rows: DataFrame) -> DataFrame:
    """Rows without ``Arrival`` are known to be alone (``without_idle_arrivals``)."""
    return repeated_keys(rows.where("Arrival is not null"), schemas.FACT_UNIQUE_KEY)


def unique_sales(rows: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """One loadable row per (order, product, date): the first by arrival."""
    packed = rows.select(*_FACT_INPUTS)
    if repeated is None:
        return first_by_minimum(packed, schemas.FACT_UNIQUE_KEY, "Arrival")
    return keep_first(packed, schemas.FACT_UNIQUE_KEY, "Arrival", repeated)


def fact_rows(sales: DataFrame) -> DataFrame:
    """The fact projection. ``Sales_Key`` is a hash of the unique key, so a replay gives the same value."""
    day = rules.day_of_key(F.col("Date_Key"))  # so that no shuffle carries both
    amount = rules.purchase_amount(F.col("Quantity"), F.col("Price"))
    discount = F.lit(0).cast(schemas.AMOUNT)
    derived = {
        "Sales_Key": F.xxhash64(*schemas.FACT_UNIQUE_KEY),
        "Order_Line_Number": F.lit(1),
        "Unit_Price": F.col("Price"),
        "Total_Purchase_Amount": amount,
        "Discount_Amount": discount,
        "Net_Sales_Amount": amount - discount,
        "Weekend_Flag": rules.is_weekend(day),
        "Order_Channel": F.lit(rules.STORE_CHANNEL),
        "Created_At": F.current_timestamp(),
        "Sale_Year": F.col("Sale_Year") if "Sale_Year" in sales.columns else F.year(day),
    }
    return sales.select(
        *[derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.FACT_SALES.fields]
    )


def placed_sales(sales: DataFrame, derive: Callable[[DataFrame], DataFrame] = fact_rows) -> DataFrame:
    year = F.floor(F.col("Date_Key") / 10000).cast("int")
    return derive(sales.hint("rebalance", "Date_Key").withColumn("Sale_Year", year).sortWithinPartitions("Sale_Year", "Date_Key"))


def write_facts(facts: DataFrame, path: str, mode: str = "append") -> int:
    """``write_sales`` for rows that are facts already."""
    return write_sales(facts, path, mode, lambda rows: rows)


def write_sales(sales: DataFrame, path: str, mode: str = "append", derive: Callable[[DataFrame], DataFrame] = fact_rows) -> int:
    """Partitioned by year; rows of a date lie together, so row groups prune by ``Date_Key``. Returns the number of rows.

    What ``derive`` adds to a sale is computed where it is written: neither shuffled nor sorted. The rebalance hint sizes the output files from the shuffle statistics and splits a hot date. Rows are counted as they
    are written, in the last stage, which counts each of them once whatever tasks run again.
    """
    seen = Observation()
    (
        placed_sales(sales, derive)
        .observe(seen, F.count(F.lit(1)).alias("loaded"))
        .write.option("compression", COMPRESSION).mode(mode)
        .partitionBy("Sale_Year")
        .parquet(path)
    )
    return seen.get["loaded"]


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, schemas.FACT_SALES).drop(PART)


# --- rejects ------------------------------------------------------------------
def rejected_rows(resolved: DataFrame) -> DataFrame:
    """Rows with a reason; equal rows come once with their number in ``Copies``."""
    return (
        resolved.where("Reason is not null")
        .groupBy(*REJECT_COLUMNS, "Reason")
        .agg(F.count(F.lit(1)).alias("Copies"))
    )


def duplicate_rows(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Loadable rows that lost against another row with the same fact key."""
    packed = rows.select(*_FACT_INPUTS)
    return (
        surplus_rows(packed, schemas.FACT_UNIQUE_KEY, "Arrival", repeated)
        .groupBy(*REJECT_COLUMNS)
        .agg(F.sum("Copies").alias("Copies"))
        .select(*REJECT_COLUMNS, F.lit(DUPLICATE).alias("Reason"), "Copies")
    )


def all_rejects(resolved: DataFrame, repeated: DataFrame) -> DataFrame:
    return rejected_rows(resolved).unionByName(duplicate_rows(loadable(resolved), repeated))


# --- facts of earlier loads ---------------------------------------------------
def stored_keys(facts: DataFrame, rows: DataFrame) -> DataFrame:
    """Unique keys of stored facts on the dates that occur in ``rows``; years without such a date are not read.

    The dates are rows of the calendar at most, so they are broadcast, which also prunes the year folders.
    """
    dates = rows.select("Date_Key").distinct().withColumn("Sale_Year", F.floor(F.col("Date_Key") / 10000).cast("int"))
    return facts.join(F.broadcast(dates), ["Sale_Year", "Date_Key"], "left_semi").select(*schemas.FACT_UNIQUE_KEY)


def marked_sales(sales: DataFrame, seen: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Unique sales with ``Stored``, whether their key is among those of the stored facts (each there once), and what was written for it.

    Facts and rejects both read the result. Few stored keys are broadcast. Of many, those that this load has again are found first,
    by keys alone; if they are few, as in most loads, the sales themselves are not shuffled. Else these are joined, once, and
    stored. Neither side is sorted: the stored keys are hashed, in as many partitions as their size asks for.
    """
    keys, narrow = schemas.FACT_UNIQUE_KEY, sales.drop("Arrival", "Sale_Date")
    if fits_broadcast(seen):
        known = stored(seen, "seen_sales")
        return narrow.join(_named(known), keys, "left"), [known]
    placed = seen.repartition(max(1, -(-estimated_bytes(seen) // SEEN_BYTES)), *keys)
    if _few_again(sales, seen):
        again = stored(sales.select(*keys).join(placed.hint("shuffle_hash"), keys, "left_semi"), "known_sales")
        return narrow.join(_named(again), keys, "left"), [again]
    found = stored(narrow.join(_named(placed).hint("shuffle_hash"), keys, "left"), "marked_sales")
    return found, [found]


def _named(keys: DataFrame) -> DataFrame:
    return keys.withColumn("Stored", F.lit(True))


def _few_again(sales: DataFrame, seen: DataFrame) -> bool:
    """Whether the sales that are stored already are few enough to broadcast their keys, by the count of a slice of all keys.

    This chooses a plan, not rows: either plan is right whatever the count.
    """
    keys = schemas.FACT_UNIQUE_KEY
    sliced = F.pmod(F.xxhash64(*keys), F.lit(SLICES)) == 0
    again = sales.select(*keys).where(sliced).join(seen.where(sliced), keys, "left_semi").count()
    return again * SLICES * KEY_BYTES <= broadcast_limit(sales.sparkSession)


def not_loaded(marked: DataFrame) -> DataFrame:
    return marked.where("Stored is null").drop("Stored")


def already_loaded(marked: DataFrame) -> DataFrame:
    """Unique sales that are stored already, as rejects (their other copies are duplicates anyway)."""
    dated = marked.where("Stored").withColumn("Sale_Date", rules.day_of_key(F.col("Date_Key")))
    return dated.select(*REJECT_COLUMNS, F.lit(DUPLICATE).alias("Reason"), F.lit(1).cast("bigint").alias("Copies"))


# --- audit --------------------------------------------------------------------
def observed_stage(resolved: DataFrame) -> tuple[DataFrame, Observation]:
    """The resolved rows, to be written, and what their write counts: rows, those with a customer, with a product too."""
    seen = Observation()
    customer_found = F.col("Customer_Key").isNotNull()
    watched = resolved.observe(
        seen, F.count(F.lit(1)).alias("streamed"), F.count_if(customer_found).alias("customer"),
        F.count_if(customer_found & F.col("Product_Key").isNotNull()).alias("product"),
    )
    return watched, seen


def write_audit(spark: SparkSession, path: str, part: str, staged: Observation, loaded: int) -> None:
    """The counts of one load, gathered by its writes; no table is read for them."""
    counts = {**staged.get, "loaded": loaded}
    row = spark.createDataFrame([tuple(counts[n] for n in schemas.LOAD_AUDIT.names)], schemas.LOAD_AUDIT)
    row.coalesce(1).write.mode("overwrite").parquet(part_folder(path, part))


def load_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row per stage over all loads: rows in, rows matched, match rate; rates are NULL on empty input."""
    counts = read_parts(spark, path, schemas.LOAD_AUDIT)
    return audit_stages(counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in schemas.LOAD_AUDIT.names]))


def audit_stages(counts: DataFrame) -> DataFrame:
    stages = F.array(
        _stage(1, "stream", "streamed", "streamed"),
        _stage(2, "customer_join", "streamed", "customer"),
        _stage(3, "product_join", "customer", "product"),
        _stage(4, "fact_load", "product", "loaded"),
        _stage(5, "end_to_end", "streamed", "loaded"),
    )
    return counts.select(F.inline(stages)).select(
        "Stage_No",
        "Stage",
        "Rows_In",
        "Rows_Out",
        (F.col("Rows_In") - F.col("Rows_Out")).alias("Rows_Dropped"),
        numeric.as_double(numeric.percent(F.col("Rows_Out"), F.col("Rows_In")), "Rate_Pct"),
    )


def _stage(number: int, name: str, rows_in: str, rows_out: str) -> Column:
    return F.struct(
        F.lit(number).alias("Stage_No"), F.lit(name).alias("Stage"),
        F.col(rows_in).alias("Rows_In"), F.col(rows_out).alias("Rows_Out"),
    )
