"""Every registered query by name, as a function of the session and the data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillstar import schemas
from tillstar.operators import profile, quality
from tillstar.operators.dedupe import keep_first, repeated_keys, surplus_rows
from tillstar.operators.keys import key_page
from tillstar.plans import bucketed, dims, load, olap, quarters
from tillstar.plans.star import FILES_PER_BATCH, Star, Warehouse, Workspace, workspace
from tillstar.session import stored
from tillstar.sources import binding, readers
from tillstar.streaming.fact_stream import FactStream, transaction_stream

# Parameters of the reports on the test data, whose orders lie in 1995-2001.
YEAR = 1997
YEARS = (1997, 1998)
CUSTOMER_PAGE_START = 100
PRODUCT_PAGE_START = "P000000000100"
PAGE_SIZE = 500

SALE = ["Order_ID", "Customer_ID", "Product_ID", "Quantity", "Sale_Date"]
NATURAL_KEY = ["Order_ID", "Product_ID", "Sale_Date"]
_INTERNAL = ("Sales_Key", "Created_At", "Source_Rows", "Sale_Year")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for output only."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
          for f in df.schema.fields]
    )


# --- cleaning and masters -----------------------------------------------------
def clean_transactions(w: Workspace) -> DataFrame:
    """The text form of the rows, parsed back into types."""
    raw = binding.raw_transactions(w.spark, w.sf_dir).select(*schemas.RAW_TRANSACTION_FIELDS)
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return readers.clean_transactions(as_text).drop("Arrival").withColumn(
        "Unparsable", F.col("Unparsable").cast("int")
    )


# --- load ---------------------------------------------------------------------
def _sales(w: Workspace) -> DataFrame:
    return w.transactions.drop("Unparsable")


def enrich_customer(w: Workspace) -> DataFrame:
    return load.enrich_customer(w.transactions.select(*SALE), w.full_dimensions.table("master_customer"))


def enrich_product(w: Workspace) -> DataFrame:
    return plain(load.enrich_product(enrich_customer(w), w.full_dimensions.table("master_product")))


def _enriched(transactions: DataFrame, masters: Warehouse) -> DataFrame:
    return load.enriched_sales(
        transactions.select(*SALE), masters.table("master_customer"), masters.table("master_product")
    )


def etl_batch_join(w: Workspace) -> DataFrame:
    return plain(_enriched(w.transactions, w.full_dimensions))


def fact_sales(w: Workspace) -> DataFrame:
    return plain(w.star.fact_sales.drop(*_INTERNAL))


def csv_fact_load(w: Workspace) -> DataFrame:
    """The load from CSV files, products with an index column."""

    def build() -> Warehouse:
        root = f"{w.root}/csv"
        sources = {
            "customers": binding.raw_customers(w.spark, w.sf_dir), "products": binding.raw_products(w.spark, w.sf_dir),
            "transactions": w.spark.read.parquet(w.landing),
        }
        for name, rows in sources.items():
            rows.write.option("header", True).csv(f"{root}/{name}")
        raw = {name: readers.read_csv(w.spark, f"{root}/{name}") for name in sources}
        # the columns that order repeated lines compare as numbers and times
        kinds = {c: sources["transactions"].schema[c].dataType for c in binding.TRANSACTION_ORDER}
        lines = raw["transactions"].withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})
        warehouse = Warehouse(w.spark, f"{root}/warehouse")
        warehouse.load_masters(readers.clean_customers(raw["customers"]), readers.clean_products(raw["products"]))
        sales = readers.clean_transactions(lines)
        warehouse.load_dimensions(dims.years_of(sales, "Sale_Date"))
        warehouse.append_sales(sales)
        return warehouse

    return plain(w.once("csv", build).table("fact_sales").drop(*_INTERNAL))


def fact_rejects(w: Workspace) -> DataFrame:
    return w.faulty_staged.rejects()


def _appended(w: Workspace) -> Warehouse:
    """Half of the orders as one batch, then all of them as a second one."""

    def build() -> Warehouse:
        warehouse = Warehouse(w.spark, f"{w.root}/append")
        warehouse.load_masters(w.customers, w.products)
        warehouse.load_dimensions(dims.years_of(w.transactions, "Sale_Date"))
        warehouse.append_sales(w.transactions.where("Order_ID % 2 = 0"))
        warehouse.append_sales(w.transactions)
        return warehouse

    return w.once("append", build)


def fact_append(w: Workspace) -> DataFrame:
    return plain(_appended(w).table("fact_sales").drop(*_INTERNAL))


def fact_dedup(w: Workspace) -> DataFrame:
    rows = _sales(w)
    return keep_first(rows, NATURAL_KEY, "Arrival", _repeated(w)).drop("Arrival")


def fact_duplicates(w: Workspace) -> DataFrame:
    surplus = surplus_rows(_sales(w), NATURAL_KEY, "Arrival", _repeated(w))
    return surplus.groupBy(*SALE).agg(F.sum("Copies").alias("Copies"))


def _repeated(w: Workspace) -> DataFrame:
    return w.once("repeated", lambda: stored(repeated_keys(_sales(w), NATURAL_KEY), "repeated_keys"))


def load_audit(w: Workspace) -> DataFrame:
    return w.faulty.audit()


def _compacted(w: Workspace) -> Warehouse:
    """The warehouse of ``fact_append``, compacted, with saved quarters that were refreshed before and after that."""

    def run() -> Warehouse:
        warehouse = _appended(w)
        quarters.refresh(w.spark, warehouse.root)
        warehouse.compact()
        quarters.refresh(w.spark, warehouse.root)
        return warehouse

    return w.once("compacted", run)


def fact_compacted(w: Workspace) -> DataFrame:
    return plain(_compacted(w).table("fact_sales").drop(*_INTERNAL))


def q20_saved_quarters(w: Workspace) -> DataFrame:
    warehouse = _compacted(w)
    return quarters.report(w.spark, warehouse.root, warehouse.table("dim_store"))


def _by_customer(w: Workspace) -> Star:
    return w.once("bucketed", lambda: bucketed.star(w.full))


def star_recreated_counts(w: Workspace) -> DataFrame:
    """Created, loaded as a stream, created anew and loaded as a stream again: everything is there once."""

    def run() -> Warehouse:
        warehouse = Warehouse(w.spark, f"{w.root}/recreated")
        layout = w.spark.read.parquet(w.landing).schema
        for folder in (w.late, w.landing):
            schemas.recreate_tables(w.spark, warehouse.root)
            warehouse.load_masters(w.customers, w.products)
            warehouse.load_dimensions(dims.years_of(w.transactions, "Sale_Date"))
            rows = transaction_stream(w.spark, folder, layout, files_per_batch=3 * FILES_PER_BATCH)
            FactStream(warehouse, warehouse.root).start(rows).awaitTermination()
        return warehouse

    warehouse = w.once("recreated", run)
    return quality.row_counts({t: warehouse.table(t) for t in (*schemas.STAR_TABLES, *schemas.MASTER_TABLES)})


def _streamed(w: Workspace) -> FactStream:
    """The fact load as a stream over the landing folder, then, as a second query, over repeated lines."""

    def run() -> FactStream:
        loader = FactStream(w.full_dimensions, f"{w.root}/stream")
        layout = w.spark.read.parquet(w.landing).schema
        for folder in (w.landing, w.late):
            rows = transaction_stream(w.spark, folder, layout, files_per_batch=w.files_per_batch)
            loader.start(rows, f"{folder}_checkpoint").awaitTermination()
        return loader

    return w.once("stream", run)


def stream_fact_load(w: Workspace) -> DataFrame:
    return plain(_streamed(w).facts().drop(*_INTERNAL))


def star_reloaded_counts(w: Workspace) -> DataFrame:
    """Tables that hold rows are left as they are: loading masters and dimensions again, from fewer rows, changes nothing."""

    def run() -> Warehouse:
        warehouse = _appended(w)
        warehouse.load_masters(w.customers.where("Customer_ID % 2 = 0"), w.products.where("Price > 1000"))
        warehouse.load_dimensions(dims.years_between(w.spark, 2030, 2031))
        return warehouse

    warehouse = w.once("reloaded", run)
    return quality.row_counts({t: warehouse.table(t) for t in (*schemas.STAR_TABLES, *schemas.MASTER_TABLES)})


def eda_joined_head(w: Workspace) -> DataFrame:
    joined = _enriched(w.transactions, w.full_dimensions)
    columns = [*SALE, "Gender", "Product_Category", "Total_Purchase"]
    return plain(profile.head(joined.select(*columns), columns))


# --- quality ------------------------------------------------------------------
def dq_key_uniqueness(w: Workspace) -> DataFrame:
    star = w.star
    return quality.key_uniqueness({
        "customer_master": (w.customers, "Customer_ID"),
        "product_master": (w.products, "Product_ID"),
        "dim_customer": (star.dim_customer, "Customer_ID"),
        "dim_product": (star.dim_product, "Product_ID"),
        "dim_store": (star.dim_store, "Store_ID"),
        "dim_supplier": (star.dim_supplier, "Supplier_ID"),
        "dim_date": (star.dim_date, "Full_Date"),
        "fact_sales": (star.fact_sales, "Sales_Key"),
    })


def dq_reconciliation(w: Workspace) -> DataFrame:
    rows = w.all_transactions.select(*SALE)
    return quality.reconciliation(rows, _enriched(rows, w.faulty_dimensions))


def dq_non_null_counts(w: Workspace) -> DataFrame:
    return quality.non_null_counts({
        "customer_master": w.customers, "product_master": w.products, "transactions": w.transactions.select(*SALE)
    })


def dq_fk_violations(w: Workspace) -> DataFrame:
    """All facts, and some of them once more with a key that no dimension has."""
    names = ("Customer_Key", "Product_Key", "Store_Key", "Supplier_Key", "Date_Key")
    wrong = lambda key: F.struct(*[(-F.col(n) if n == key else F.col(n)).alias(n) for n in names])
    broken = [F.when(F.col("Order_ID") % 50 == k, wrong(key)) for k, key in enumerate(names, 1)]
    keys = w.star.fact_sales.select(F.inline(F.array_compact(F.array(F.struct(*names), *broken))))
    return quality.foreign_key_violations(replace(w.star, fact_sales=keys))


def dq_constraint_violations(w: Workspace) -> DataFrame:
    """The rules of the fact table on all rows before rejection, and of every stored table after it.

    The added rows are all rejected, so the facts of their load are those of the load without them: one load serves both.
    """
    keys = ("Order_ID", "Customer_Key", "Product_Key", "Store_Key", "Supplier_Key", "Date_Key", "Quantity")
    h, dim = w.faulty, w.full_dimensions.table
    fact_rules = {**quality.positive_rule("Quantity"), **quality.not_null_rules(*keys)}
    return quality.constraint_violations({
        "staged_sales": (h.table("stage_sales"), {**fact_rules, **quality.not_null_rules("Price")}),
        "fact_sales": (
            h.table("fact_sales"), {**fact_rules, **quality.not_null_rules("Unit_Price", "Total_Purchase_Amount")}
        ),
        "dim_date": (dim("dim_date"), quality.not_null_rules("Full_Date")),
        "dim_customer": (dim("dim_customer"), quality.not_null_rules("Customer_ID")),
        "dim_product": (dim("dim_product"), quality.not_null_rules("Product_ID")),
        "dim_store": (dim("dim_store"), quality.not_null_rules("Store_ID")),
        "dim_supplier": (dim("dim_supplier"), quality.not_null_rules("Supplier_ID")),
    })


def eda_distinct_sketch(w: Workspace) -> DataFrame:
    keys = ["Customer_ID", "Product_ID", "Order_ID"]
    daily = w.once("sketches", lambda: stored(profile.distinct_sketches(w.transactions, "Sale_Date", keys), "sketches"))
    return profile.sketch_check(w.transactions, daily, keys)


def _lookups(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {t: dims.key_lookup(warehouse.table(t), t) for t in schemas.STAR_TABLES if t != "fact_sales"}


_BUILDERS: dict[str, Callable[[Workspace], DataFrame]] = {
    # reports
    "q01_top_products_day_type_monthly": lambda w: olap.top_products_by_day_type_monthly(w.star, YEAR),
    "q02_demographics_share": lambda w: olap.demographics_share(w.star),
    "q03_category_by_occupation": lambda w: olap.category_by_occupation(w.star),
    "q04_gender_age_quarterly": lambda w: olap.gender_age_quarterly(w.star, YEAR),
    "q05_top_occupations_per_category": lambda w: olap.top_occupations_per_category(w.star),
    "q06_city_marital_last6m": lambda w: olap.city_marital_recent_months(w.star),
    "q07_stay_gender_avg": lambda w: olap.stay_and_gender_average(w.star),
    "q08_top_cities_per_category": lambda w: olap.top_cities_per_category(w.star),
    "q09_monthly_growth": lambda w: olap.monthly_growth_by_category(w.star, YEAR),
    "q10_weekend_vs_weekday_by_age": lambda w: olap.weekend_share_by_age(w.star, YEAR),
    "q11_top5_products_month_day_type": lambda w: olap.top_products_per_month_and_day_type(w.star, YEAR),
    "q12_store_quarterly_growth": lambda w: olap.store_quarterly_growth(w.star, YEAR),
    "q13_supplier_store_product": lambda w: olap.supplier_store_product(w.star),
    "q14_product_season": lambda w: olap.product_by_season(w.star),
    "q15_store_supplier_volatility": lambda w: olap.store_supplier_volatility(w.star),
    "q16_product_affinity": lambda w: olap.product_affinity(w.star),
    "q17_yearly_rollup": lambda w: olap.yearly_rollup(w.star, YEARS),
    "q18_half_year_split": lambda w: olap.half_year_split(w.star, YEAR),
    "q19_daily_spikes": lambda w: olap.daily_spikes(w.star),
    "q20_store_quarterly_sales": lambda w: olap.store_quarterly_sales(w.star),
    "q20_saved_quarters": q20_saved_quarters,
    "bucketed_q02": lambda w: olap.demographics_share(_by_customer(w)),
    "bucketed_q03": lambda w: olap.category_by_occupation(_by_customer(w)),
    "bucketed_q05": lambda w: olap.top_occupations_per_category(_by_customer(w)),
    "bucketed_q08": lambda w: olap.top_cities_per_category(_by_customer(w)),
    # cleaning and masters
    "clean_transactions": clean_transactions,
    "clean_products": lambda w: plain(w.products),
    "master_customer": lambda w: w.full_dimensions.table("master_customer"),
    "master_product": lambda w: plain(w.full_dimensions.table("master_product")),
    # dimensions
    "dim_date": lambda w: dims.dim_date(dims.years_of(w.transactions, "Sale_Date")),
    "dim_customer": lambda w: w.full_dimensions.table("dim_customer"),
    "dim_product": lambda w: plain(w.full_dimensions.table("dim_product")),
    "dim_store": lambda w: plain(w.full_dimensions.table("dim_store")),
    "dim_supplier": lambda w: plain(w.full_dimensions.table("dim_supplier")),
    "dim_lookup_counts": lambda w: quality.row_counts(_lookups(w.full_dimensions)),
    "star_row_counts": lambda w: quality.row_counts(
        {t: w.full.table(t) for t in (*schemas.STAR_TABLES, *schemas.MASTER_TABLES)}
    ),
    "star_recreated_counts": star_recreated_counts,
    "star_reloaded_counts": star_reloaded_counts,
    # load
    "enrich_customer": enrich_customer,
    "enrich_product": enrich_product,
    "fact_sales": fact_sales,
    "fact_append": fact_append,
    "fact_compacted": fact_compacted,
    "csv_fact_load": csv_fact_load,
    "fact_rejects": fact_rejects,
    "fact_dedup": fact_dedup,
    "fact_duplicates": fact_duplicates,
    "etl_batch_join": etl_batch_join,
    "master_customer_page": lambda w: key_page(
        w.full_dimensions.table("master_customer"), "Customer_ID", CUSTOMER_PAGE_START, PAGE_SIZE
    ),
    "master_product_page": lambda w: plain(
        key_page(w.full_dimensions.table("master_product"), "Product_ID", PRODUCT_PAGE_START, PAGE_SIZE)
    ),
    "load_audit": load_audit,
    "stream_fact_load": stream_fact_load,
    "stream_load_audit": lambda w: _streamed(w).audit(),
    # quality
    "dq_key_uniqueness": dq_key_uniqueness,
    "dq_orphan_customers": lambda w: quality.orphans(
        w.all_transactions, w.faulty_dimensions.table("master_customer"), "Customer_ID"
    ),
    "dq_orphan_products": lambda w: quality.orphans(w.all_transactions, w.faulty_dimensions.table("master_product"), "Product_ID"),
    "dq_reconciliation": dq_reconciliation,
    "dq_non_null_counts": dq_non_null_counts,
    "dq_fk_violations": dq_fk_violations,
    "dq_constraint_violations": dq_constraint_violations,
    "dq_multi_product_orders": lambda w: quality.multi_product_orders(w.star.fact_sales),
    # profiles
    "eda_customer_value_counts": lambda w: profile.value_counts(
        w.customers,
        ["Age", "Occupation", "City_Category", "Stay_In_Current_City_Years", "Gender", "Marital_Status"],
    ),
    "eda_category_counts": lambda w: profile.counts_by_frequency(w.products, "Product_Category"),
    "eda_distinct_entities": lambda w: profile.distinct_counts(w.products, ["StoreName", "SupplierName"]),
    "eda_distinct_sketch": eda_distinct_sketch,
    "eda_price_summary": lambda w: profile.summary(w.products, "Price"),
    "eda_quantity_summary": lambda w: profile.summary(w.transactions, "Quantity"),
    "eda_joined_head": eda_joined_head,
    "eda_quantity_counts": lambda w: profile.counts_by_value(w.transactions, "Quantity"),
    "eda_date_range": lambda w: profile.date_range(w.transactions, "Sale_Date"),
    "eda_tx_by_year": lambda w: profile.rows_per_year(w.transactions, "Sale_Date"),
    "eda_hot_customers": lambda w: profile.hot_keys(w.transactions, "Customer_ID"),
    "eda_hot_products": lambda w: profile.hot_keys(w.transactions, "Product_ID"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Workspace], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(workspace(spark, sf_dir))

    return {name: bound(build) for name, build in _BUILDERS.items()}
