"""Command line: load a warehouse from CSV files, run its reports, analyse the raw files.

    spark-submit tillstar/job.py etl --customers c.csv --products p.csv --transactions folder --warehouse dir
    spark-submit tillstar/job.py report --warehouse dir --year 2017 q10
    spark-submit tillstar/job.py analyse --customers c.csv --products p.csv --transactions t.csv

For ``etl --stream`` the transactions are a folder that is read as a stream up to its present end;
calling it again continues with new files. Reports are written to ``--output`` or shown.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillstar import schemas
from tillstar.operators import profile, quality
from tillstar.plans import bucketed, dims, load, olap, quarters
from tillstar.plans.star import Star, Warehouse
from tillstar.session import cluster_settings
from tillstar.sources import readers
from tillstar.streaming.fact_stream import FactStream, batch_rates, transaction_stream

REPORTS: dict[str, Callable[[Star, int, tuple[int, ...]], DataFrame]] = {
    "q01": lambda s, year, years: olap.top_products_by_day_type_monthly(s, year),
    "q02": lambda s, year, years: olap.demographics_share(s),
    "q03": lambda s, year, years: olap.category_by_occupation(s),
    "q04": lambda s, year, years: olap.gender_age_quarterly(s, year),
    "q05": lambda s, year, years: olap.top_occupations_per_category(s),
    "q06": lambda s, year, years: olap.city_marital_recent_months(s),
    "q07": lambda s, year, years: olap.stay_and_gender_average(s),
    "q08": lambda s, year, years: olap.top_cities_per_category(s),
    "q09": lambda s, year, years: olap.monthly_growth_by_category(s, year),
    "q10": lambda s, year, years: olap.weekend_share_by_age(s, year),
    "q11": lambda s, year, years: olap.top_products_per_month_and_day_type(s, year),
    "q12": lambda s, year, years: olap.store_quarterly_growth(s, year),
    "q13": lambda s, year, years: olap.supplier_store_product(s),
    "q14": lambda s, year, years: olap.product_by_season(s),
    "q15": lambda s, year, years: olap.store_supplier_volatility(s),
    "q16": lambda s, year, years: olap.product_affinity(s),
    "q17": lambda s, year, years: olap.yearly_rollup(s, years),
    "q18": lambda s, year, years: olap.half_year_split(s, year),
    "q19": lambda s, year, years: olap.daily_spikes(s),
    "q20": lambda s, year, years: olap.store_quarterly_sales(s),
}


def etl(
    spark: SparkSession, customers: str, products: str, transactions: str, root: str,
    years: tuple[int, int] = (2015, 2020), stream: bool = False, rebuild: bool = False,
    bytes_per_batch: int | None = None, archive: str | None = None,
) -> Warehouse:
    """Masters, dimensions, then facts and rejects; dimensions that hold rows are left as they are.

    Facts are added to those that exist; ``rebuild`` replaces all facts and rejects by this input. A stream takes 64 files
    a batch, or ``bytes_per_batch``, and moves loaded files to ``archive``, if there is one.
    """
    warehouse = Warehouse(spark, root)
    warehouse.load_masters(
        readers.clean_customers(readers.read_csv(spark, customers)),
        readers.clean_products(readers.read_csv(spark, products)),
    )
    warehouse.load_dimensions(dims.years_between(spark, *years))
    if rebuild:
        schemas.drop_loads(spark, root)
    if stream:
        names = readers.read_csv(spark, transactions).columns
        layout = StructType([StructField(n, StringType()) for n in names])
        rows = transaction_stream(spark, transactions, layout, "csv", 64, bytes_per_batch, archive)
        query = FactStream(warehouse, root).start(rows)
        query.awaitTermination()
        batch_rates(spark, query).show(truncate=False)
    else:
        warehouse.append_sales(readers.clean_transactions(readers.read_csv(spark, transactions)))
    return warehouse


def create(spark: SparkSession, root: str) -> None:
    """Drop and create all tables of a warehouse, empty."""
    schemas.recreate_tables(spark, root)


def maintain(spark: SparkSession, root: str, by_customer: bool = False) -> None:
    """Compact the folders of many loads and bring the saved quarters and, if asked for, the facts by customer up to date."""
    warehouse = Warehouse(spark, root)
    warehouse.compact()
    quarters.refresh(spark, root)
    quarters.clean(spark, root)
    if by_customer:
        bucketed.build(warehouse)
    bucketed.clean(warehouse)


def star_for_reports(warehouse: Warehouse) -> Star:
    """With facts by customer, if there is a copy that is up to date."""
    return bucketed.star(warehouse) if bucketed.current(warehouse) else warehouse.star


def analysis(spark: SparkSession, customers: str, products: str, transactions: str) -> dict[str, DataFrame]:
    """Every quality and profile report of the raw files, by name."""
    people = readers.clean_customers(readers.read_csv(spark, customers))
    goods = readers.clean_products(readers.read_csv(spark, products))
    sales = readers.clean_transactions(readers.read_csv(spark, transactions))
    joined = load.enriched_sales(sales.drop("Arrival", "Unparsable"), people, goods)
    return {
        "columns": quality.non_null_counts(
            {"customers": people, "products": goods, "transactions": sales.drop("Arrival", "Unparsable")}
        ),
        "key_uniqueness": quality.key_uniqueness(
            {"customers": (people, "Customer_ID"), "products": (goods, "Product_ID")}
        ),
        "orphan_customers": quality.orphans(sales, people, "Customer_ID"),
        "orphan_products": quality.orphans(sales, goods, "Product_ID"),
        "customer_values": profile.value_counts(
            people, ["Age", "Occupation", "City_Category", "Stay_In_Current_City_Years"]
        ),
        "genders": profile.counts_by_frequency(people, "Gender"),
        "marital_status": profile.counts_by_frequency(people, "Marital_Status"),
        "categories": profile.counts_by_frequency(goods, "Product_Category"),
        "distinct_entities": profile.distinct_counts(goods, ["StoreName", "SupplierName"]),
        "price": profile.summary(goods, "Price"),
        "quantity": profile.summary(sales, "Quantity"),
        "quantities": profile.counts_by_value(sales, "Quantity"),
        "date_range": profile.date_range(sales, "Sale_Date"),
        "transactions_per_year": profile.rows_per_year(sales, "Sale_Date"),
        "frequent_customers": profile.hot_keys(sales, "Customer_ID"),
        "frequent_products": profile.hot_keys(sales, "Product_ID"),
        "multi_product_orders": quality.multi_product_orders(sales, product="Product_ID"),
        "reconciliation": quality.reconciliation(sales, joined),
        "joined_columns": quality.non_null_counts({"joined": joined}),
        "joined_head": profile.head(joined, ["Order_ID", "Product_ID"]),
    }


def _deliver(name: str, df: DataFrame, output: str | None) -> None:
    if output:
        df.write.mode("overwrite").option("header", True).csv(f"{output}/{name}")
    else:
        print(name)
        df.show(20, truncate=False)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillstar")
    commands = parser.add_subparsers(dest="command", required=True)
    sub = commands.add_parser("maintain", help="compact the folders of many loads, refresh the saved quarters")
    sub.add_argument("--warehouse", required=True)
    sub.add_argument("--by-customer", action="store_true", help="store the facts once more, bucketed by customer, for reports")
    for command in ("etl", "analyse"):
        sub = commands.add_parser(command)
        for name in ("customers", "products", "transactions"):
            sub.add_argument(f"--{name}", required=True)
        if command == "etl":
            sub.add_argument("--warehouse", required=True)
            sub.add_argument("--first-year", type=int, default=2015)
            sub.add_argument("--last-year", type=int, default=2020)
            sub.add_argument("--stream", action="store_true", help="read the transactions folder as a stream")
            sub.add_argument("--bytes-per-batch", type=int, help="bytes of a stream's batch, instead of 64 files")
            sub.add_argument("--archive", help="folder to which a stream moves files that it has loaded")
            sub.add_argument("--rebuild", action="store_true", help="replace all facts and rejects by this input")
        else:
            sub.add_argument("--output")
    sub = commands.add_parser("create")
    sub.add_argument("--warehouse", required=True)
    sub = commands.add_parser("report")
    sub.add_argument("--warehouse", required=True)
    sub.add_argument("--year", type=int, default=2017)
    sub.add_argument("--years", type=int, nargs="+", default=[2017, 2018])
    sub.add_argument("--output")
    sub.add_argument("names", nargs="*", default=[], help="report names; none for all")
    parser.add_argument("--input-bytes", type=int, default=0, help="size of the input, to set shuffle partitions by")
    parser.add_argument("--cores", type=int, default=0, help="cores of all executors together")
    given = parser.parse_args(arguments)

    settings = cluster_settings(given.input_bytes, given.cores) if given.input_bytes else {}
    spark = SparkSession.builder.appName("tillstar").config(map=settings).getOrCreate()
    if given.command == "etl":
        warehouse = etl(
            spark, given.customers, given.products, given.transactions, given.warehouse,
            (given.first_year, given.last_year), given.stream, given.rebuild,
            given.bytes_per_batch, given.archive,
        )
        rejects = warehouse.all_rejects()
        quality.row_counts({t: warehouse.table(t) for t in schemas.STAR_TABLES}).show()
        rejects.groupBy("Reason").agg(F.sum("Copies").alias("Rows")).show()
        warehouse.audit().show(truncate=False)
    elif given.command == "maintain":
        maintain(spark, given.warehouse, given.by_customer)
    elif given.command == "create":
        create(spark, given.warehouse)
    elif given.command == "report":
        star = star_for_reports(Warehouse(spark, given.warehouse))
        for name in given.names or REPORTS:
            _deliver(name, REPORTS[name](star, given.year, tuple(given.years)), given.output)
    else:
        for name, df in analysis(spark, given.customers, given.products, given.transactions).items():
            _deliver(name, df, given.output)


if __name__ == "__main__":
    main()
