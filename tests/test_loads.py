"""Second loads, recreated tables and rows that cannot be stored."""

import os

from conftest import rows
from fixtures import customers, empty_warehouse, products, reasons, transactions

from tillstar import schemas
from tillstar.plans import dims
from tillstar.plans.star import Warehouse

SALES = [(1, 1, "A", 2, "2017-01-07"), (2, 2, "B", 1, "2017-05-01")]


def load(spark, w):
    w.load_masters(customers(spark), products(spark))
    w.load_dimensions(dims.years_between(spark, 2017, 2018))
    w.append_sales(transactions(spark, SALES))


def test_batches_add_up(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    w.append_sales(transactions(spark, SALES))
    w.append_sales(transactions(spark, [(9, 3, "C", 1, "2018-05-01")]))
    assert rows(w.table("fact_sales").select("Order_ID")) == [(1,), (2,), (9,)]
    w.append_sales(transactions(spark, SALES))
    assert w.table("fact_sales").count() == 3
    assert reasons(w.all_rejects()) == {"duplicate": 2}


def test_recreated_and_half_written_tables_are_loaded(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    schemas.recreate_tables(spark, w.root)
    assert w.table("dim_customer").count() == 0 and w.table("fact_sales").count() == 0
    load(spark, w)
    counts = {t: w.table(t).count() for t in schemas.STAR_TABLES}
    assert counts["dim_customer"] == 4 and counts["dim_product"] == 5 and counts["fact_sales"] == 2
    load(spark, w)
    assert {t: w.table(t).count() for t in schemas.STAR_TABLES} == counts
    schemas.recreate_tables(spark, w.root)
    os.remove(f"{w.root}/master_customer/_SUCCESS")
    os.makedirs(f"{w.root}/master_customer/_temporary/0")
    load(spark, w)
    assert {t: w.table(t).count() for t in schemas.STAR_TABLES} == counts


def test_rows_that_cannot_be_stored_are_rejected(spark, tmp_path):
    goods = [("A", "Toys", "10.00", "1", "North", "7", "Acme"), ("N", "Toys", None, "1", "North", "7", "Acme")]
    w = empty_warehouse(spark, tmp_path / "w", product_rows=goods)
    w.append_sales(transactions(spark, [(1, 1, "A", 2, "2017-01-07"), (2, 1, "N", 2, "2017-01-07"), (3, 1, "A", 2000000000, "2017-01-07")]))
    assert rows(w.table("fact_sales").select("Order_ID")) == [(1,)]
    assert reasons(w.all_rejects()) == {"price_missing": 1, "amount_out_of_range": 1}
