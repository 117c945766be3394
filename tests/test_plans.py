"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillstar import catalog
from tillstar.operators.skew import hot_keys, join_repeated, with_salt
from tillstar.plans import load, olap
from tillstar.plans.summary import sales_in_year
from tillstar.session import broadcast_limit, estimated_bytes, fits_broadcast


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", catalog.queries())
def test_no_cartesian_product_and_no_python(spark, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "ArrowEval"):
        assert node not in text


def test_year_slice_prunes_partitions_and_columns(spark, small_workspace):
    text = plan(sales_in_year(small_workspace.star, 1997, "Month").groupBy("Month").agg(F.sum("Quantity")))
    scan = next(line for line in text.splitlines() if "Sale_Year" in line and "FileScan" in line)
    assert re.search(r"PartitionFilters: \[.*\(Sale_Year#\d+ = 1997\)", scan)
    assert "ReadSchema: struct<Date_Key:int,Quantity:int>" in scan


def test_rank_limits_before_the_shuffle(spark, small_workspace):
    for report in (
        olap.top_products_by_day_type_monthly(small_workspace.star, 1997),
        olap.top_products_per_month_and_day_type(small_workspace.star, 1997),
        olap.top_occupations_per_category(small_workspace.star),
    ):
        assert "Partial" in [m for m in re.findall(r"WindowGroupLimit .*, (Partial|Final)", plan(report))]


def test_top_k_does_not_sort_everything(spark, small_workspace):
    text = plan(olap.product_affinity(small_workspace.star))
    assert "TakeOrderedAndProject" in text


def test_facts_are_read_once(spark, small_workspace):
    for report in (olap.top_products_by_day_type_monthly(small_workspace.star, 1997), olap.daily_spikes(small_workspace.star)):
        assert plan(report).count("Total_Purchase_Amount:decimal") == 1


def test_no_distinct_count_expands_the_facts(spark, small_workspace):
    for report in (olap.demographics_share(small_workspace.star), olap.store_quarterly_sales(small_workspace.star)):
        assert "Expand" not in plan(report)


def test_broadcast_decision_follows_the_size(spark, small_workspace):
    lookup = small_workspace.star.dim_customer.select("Customer_Key", "Age")
    assert 0 < estimated_bytes(lookup) < broadcast_limit(spark)
    assert fits_broadcast(lookup)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        assert broadcast_limit(spark) == 100
        assert not fits_broadcast(lookup)
        # sums per customer come before the join
        text = plan(olap.weekend_share_by_age(small_workspace.star, 1997))
        below_join = text[text.index("SortMergeJoin"):]
        assert re.search(r"HashAggregate\(keys=\[Customer_Key#\d+L\], functions=\[partial_sum", below_join)
        # two large dimensions: raw facts are summed per both keys before the first join
        text = plan(olap.category_by_occupation(small_workspace.star))
        facts = text[: text.index("Sale_Year")].splitlines()[::-1]
        above = next(line for line in facts if "Exchange" in line or "HashAggregate" in line)
        assert "partial_sum" in above and "Product_Key" in above and "Customer_Key" in above
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_bounded_and_salted(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    hot = hot_keys(df, ["k"], share=10, min_rows=100)
    assert [(r.k, r["_rows"]) for r in hot.collect()] == [(1, 1001)]
    salted = with_salt(df, ["k"], [F.col("id")], share=10, min_rows=100)
    assert salted.where("k <> 1").agg(F.max("_salt")).first()[0] == 0
    assert salted.where("k = 1").select("_salt").distinct().count() == 11
    assert salted.count() == 3000


def test_join_repeated_is_an_inner_join(spark):
    left = spark.range(3000).select((F.col("id") % 3 * F.col("id")).alias("k"), "id")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    for share in (2, 10, 10_000):
        joined = join_repeated(left, counts, ["k"], "n", share)
        assert joined.count() == 3000
        assert joined.agg(F.sum("n")).first()[0] == pairs


def test_skewed_customers_are_split_at_run_time(spark, small_workspace, tmp_path):
    """With the lookup too large to broadcast, adaptive execution splits the hot customer."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
    }
    rows = small_workspace.transactions
    path = str(tmp_path / "skewed")
    rows.withColumn("Customer_ID", F.when(F.col("Order_ID") % 3 > 0, F.lit(7)).otherwise(F.col("Customer_ID"))).repartition(
        8
    ).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        resolved = load.resolve(spark.read.parquet(path), *small_workspace.full.lookups())
        assert len(resolved.collect()) == rows.count()
        assert "skew=true" in plan(resolved)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_seasons_are_ordered_before_their_measures_are_worked_out(spark, small_workspace):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        text = plan(olap.product_by_season(small_workspace.star))
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
    ordered = text.index("Exchange rangepartitioning")
    assert "AS Avg_Transaction_Value" in text[:ordered] and "AS Avg_Transaction_Value" not in text[ordered:]
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
