"""What large loads shuffle, sort and build: no more than their result needs."""

import re

import pytest
from conftest import SMALL
from fixtures import empty_warehouse, reasons, transactions
from pyspark.sql import functions as F

from tillstar import catalog
from tillstar.functions import rules
from tillstar.plans import load
from tillstar.plans.star import Workspace
from tillstar.sources import binding


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_lookups(spark):
    """Nothing is small enough to be broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_raw_lines_are_landed_behind_one_shuffle(spark, tmp_path):
    landed = binding.raw_transactions(spark, SMALL, 24)
    assert plan(landed).count("Exchange hashpartitioning") == 2 and "Sort" not in plan(landed)
    landed.write.parquet(str(tmp_path / "landed"))
    files = spark.read.parquet(str(tmp_path / "landed")).select("orderID", "_metadata.file_name")
    assert files.select("file_name").distinct().count() == 24
    assert files.distinct().groupBy("orderID").count().where("count > 1").isEmpty()
    assert files.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_large_lookups_are_joined_without_a_sort(spark, small_workspace, large_lookups):
    w = small_workspace
    resolved = load.resolve(w.transactions, *w.full_dimensions.lookups())
    for joined in (resolved, catalog.etl_batch_join(w), catalog.enrich_customer(w), catalog.dq_reconciliation(w)):
        assert "Sort" not in plan(joined) and "ShuffledHashJoin" in plan(joined)


@pytest.mark.parametrize("name", ["etl_batch_join", "enrich_customer", "dim_lookup_counts", "dq_reconciliation", "dim_date", "master_product"])
def test_queries_without_facts_load_none(spark, name):
    w = Workspace(spark, SMALL)
    catalog._BUILDERS[name](w)
    assert not {"full", "faulty", "faulty_stage"} & set(w._built)


def test_rejects_do_without_facts(spark):
    w = Workspace(spark, SMALL)
    catalog.fact_rejects(w)
    assert "faulty_stage" in w._built and "faulty" not in w._built


def test_facts_are_derived_behind_the_shuffle(spark, small_workspace):
    w = small_workspace.full
    sales = load.unique_sales(load.loadable(w.table("stage_sales")), w.table("stage_repeated"))
    text = plan(load.placed_sales(sales))
    derived, shuffled = text[: text.index("Exchange")], text[text.index("Exchange"):]
    assert "AS Sales_Key" in derived and "AS Sales_Key" not in shuffled
    assert text.count("Sort [Sale_Year") == 1
    rows = shuffled.splitlines()[1]
    assert not re.search(r"Arrival|Customer_ID|Product_ID", rows)


def test_known_sales_are_found_in_one_join_without_a_sort(spark, tmp_path, large_lookups):
    w = empty_warehouse(spark, tmp_path / "w")
    first = [(k, k % 4 + 1, "ABCD"[k % 4], 1, "2017-01-07") for k in range(40)]
    w.append_sales(transactions(spark, first))
    rows = load.loadable(load.resolve(transactions(spark, first + [(99, 1, "A", 1, "2017-01-07")]), *w.lookups()))
    marked, written = load.marked_sales(load.unique_sales(rows), load.stored_keys(w.table("fact_sales"), rows))
    assert len(written) == 1
    assert load.not_loaded(marked).count() == 1 and load.already_loaded(marked).count() == 40
    assert reasons(w.append_sales(transactions(spark, first + [(99, 1, "A", 1, "2017-01-07")]))) == {"duplicate": 40}
    assert w.table("fact_sales").where(F.col("Order_ID") == 99).count() == 1


def test_only_lines_that_occur_again_carry_their_arrival(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    lines = transactions(spark, [(1, 1, "A", 2, "2017-01-07"), (1, 2, "A", 1, "2017-01-07"), (1, 1, "B", 1, "2017-01-07"), (2, 1, "A", 1, "2017-01-07")])
    narrow, _ = load.without_idle_arrivals(lines)
    assert narrow.columns == lines.columns and narrow.count() == 4
    assert {(r.Order_ID, r.Product_ID) for r in narrow.where("Arrival is not null").collect()} == {(1, "A")}
    assert narrow.where("Arrival is not null").count() == 2
    assert reasons(w.append_sales(lines)) == {"duplicate": 1}
    first = w.table("fact_sales").where("Order_ID = 1 and Source_Rows = 2").collect()
    assert [r.Quantity for r in first] == [1]


def test_all_lines_keep_their_arrival_without_broadcasts(spark, tmp_path, large_lookups):
    w = empty_warehouse(spark, tmp_path / "w")
    lines = transactions(spark, [(1, 1, "A", 2, "2017-01-07"), (1, 2, "A", 1, "2017-01-07"), (2, 1, "A", 1, "2017-01-07")])
    assert load.without_idle_arrivals(lines)[0].where("Arrival is null").isEmpty()
    assert reasons(w.append_sales(lines)) == {"duplicate": 1}


def test_new_sales_are_not_shuffled_to_find_that_they_are_new(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    w.append_sales(transactions(spark, [(k, k % 4 + 1, "ABCD"[k % 4], 1, "2017-01-07") for k in range(40)]))
    rows = load.loadable(load.resolve(transactions(spark, [(k, 1, "A", 1, "2017-01-07") for k in range(100, 140)]), *w.lookups()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        marked, written = load.marked_sales(load.unique_sales(rows), load.stored_keys(w.table("fact_sales"), rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [df.columns for df in written] == [["Order_ID", "Product_Key", "Date_Key"]]
    assert load.not_loaded(marked).count() == 40 and load.already_loaded(marked).isEmpty()


def test_constraints_are_checked_on_one_load(spark):
    w = Workspace(spark, SMALL)
    catalog.dq_constraint_violations(w)
    assert "faulty" in w._built and "full" not in w._built


@pytest.mark.parametrize("day", ["1992-02-29", "2017-12-31", "2020-01-01"])
def test_a_day_comes_back_from_its_key(spark, day):
    there = spark.range(1).select(F.lit(day).cast("date").alias("d"))
    assert there.select(rules.day_of_key(rules.date_key(F.col("d"))) == F.col("d")).first()[0]
