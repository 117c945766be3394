import pytest
from conftest import rows
from fixtures import star
from pyspark.sql import functions as F

from tillstar.plans import olap


def catalogue(count):
    return [(f"P{i}", "Toys", "1.00", "1", "North", "7", "Acme") for i in range(count)]


def test_rank_keeps_ties_and_row_number_does_not(spark, tmp_path):
    # monthly revenue 9, 8, 7, 6, 5, 5, 5 on one weekday
    sales = [(i, 1, f"P{i}", q, "2017-01-04") for i, q in enumerate([9, 8, 7, 6, 5, 5, 5])]
    s = star(spark, tmp_path, sales, product_rows=catalogue(7))
    yearly = olap.top_products_by_day_type_monthly(s, 2017).collect()
    assert [r.Day_Rank for r in yearly] == [1, 2, 3, 4, 5, 5, 5]
    monthly = olap.top_products_per_month_and_day_type(s, 2017).collect()
    assert [(r.Product_ID, r.Revenue_Rank) for r in monthly] == [(f"P{i}", i + 1) for i in range(5)]


def test_yearly_rank_uses_all_months(spark, tmp_path):
    sales = [(1, 1, "P0", 5, "2017-01-04"), (2, 1, "P1", 3, "2017-01-04"), (3, 1, "P1", 3, "2017-02-01"), (4, 1, "P0", 9, "2018-01-03")]
    s = star(spark, tmp_path, sales, product_rows=catalogue(2))
    found = [(r.Product_ID, r.Day_Rank, r.Month, r.Monthly_Revenue, r.Yearly_Revenue) for r in olap.top_products_by_day_type_monthly(s, 2017).collect()]
    assert found == [("P1", 1, 1, 3.0, 6.0), ("P1", 1, 2, 3.0, 6.0), ("P0", 2, 1, 5.0, 5.0)]


def test_growth_uses_the_previous_month_with_sales(spark, tmp_path):
    sales = [(1, 1, "Z", 3, "2017-01-04"), (2, 1, "D", 4, "2017-03-04"), (3, 1, "D", 5, "2017-04-04")]
    s = star(spark, tmp_path, sales)
    found = [(r.Month, r.Previous_Month_Sales, r.Growth_Percentage) for r in olap.monthly_growth_by_category(s, 2017).collect()]
    assert found == [(1, None, None), (3, 0.0, None), (4, 4.0, 25.0)]
    volatility = olap.store_supplier_volatility(s).collect()
    assert [(r.Month, r.Volatility_Percentage) for r in volatility] == [(1, None), (3, None), (4, 25.0)]


def test_spike_of_exactly_twice_the_average_counts(spark, tmp_path):
    sales = [(1, 1, "D", 1, "2017-01-04"), (2, 1, "D", 1, "2017-01-05"), (3, 1, "D", 4, "2017-01-06")]
    found = [(str(r.Full_Date), r.Avg_Daily_Sales, r.Sales_Multiple) for r in olap.daily_spikes(star(spark, tmp_path, sales)).collect()]
    assert found == [("2017-01-06", 2.0, 2.0)]


def test_free_products_are_spikes_without_multiple(spark, tmp_path):
    found = olap.daily_spikes(star(spark, tmp_path, [(1, 1, "Z", 1, "2017-01-04")])).collect()
    assert [(r.Daily_Sales, r.Sales_Multiple) for r in found] == [(0.0, None)]


def test_recent_months_exclude_the_first_bound(spark, tmp_path):
    sales = [(1, 1, "D", 1, "2018-06-30"), (2, 1, "D", 1, "2018-07-01"), (3, 2, "D", 1, "2018-12-31"), (4, 2, "D", 1, "2018-12-30")]
    found = [(r.City_Category, r.Month, r.Total_Transactions, r.Unique_Customers) for r in olap.city_marital_recent_months(star(spark, tmp_path, sales)).collect()]
    assert found == [("A", 7, 1, 1), ("B", 12, 2, 1)]


def test_baskets(spark, tmp_path):
    sales = [(o, 1, p, 1, "2017-01-04") for o, items in enumerate(["AB", "AB", "AB", "AC", "AC", "D"]) for p in items]
    found = [(r.Product1_ID, r.Product2_ID, r.Times_Bought_Together) for r in olap.product_affinity(star(spark, tmp_path, sales)).collect()]
    assert found == [("A", "B", 3), ("A", "C", 2)]


SALES = [
    (o, 1 + o % 4, "ABCD"[(o * 7 + m) % 4], 1 + (o * m) % 5, f"{y}-{m:02d}-{1 + o % 28:02d}")
    for y in (2017, 2018) for m in range(1, 13) for o in range(m * 40 + y, m * 40 + y + 25)
]


@pytest.fixture(scope="module")
def year_star(spark, tmp_path_factory):
    return star(spark, tmp_path_factory.mktemp("year"), SALES)


def total(s, condition="true"):
    return float(s.fact_sales.where(condition).agg(F.sum("Total_Purchase_Amount")).first()[0])


def test_rollup_levels_add_up(year_star):
    found = olap.yearly_rollup(year_star, (2017, 2018)).collect()
    level = {}
    for r in found:
        depth = sum([r.Year is not None, r.StoreName != "ALL STORES", r.SupplierName != "ALL SUPPLIERS", r.Product_ID != "ALL PRODUCTS"])
        level[depth] = level.get(depth, 0) + r.Total_Revenue
    assert set(level) == {0, 1, 2, 3, 4}
    assert all(v == pytest.approx(total(year_star)) for v in level.values())
    assert [r for r in found if r.Year is None][0].StoreName == "ALL STORES"


def test_parts_add_up(year_star):
    halves = olap.half_year_split(year_star, 2017).collect()
    assert all(r.H1_Revenue + r.H2_Revenue == pytest.approx(r.Yearly_Revenue) for r in halves)
    assert sum(r.Yearly_Revenue for r in halves) == pytest.approx(total(year_star, "Sale_Year = 2017"))
    weekend = olap.weekend_share_by_age(year_star, 2017).collect()
    assert all(r.Weekday_Sales + r.Weekend_Sales == pytest.approx(r.Total_Sales) for r in weekend)
    assert sum(r.Revenue_Share_Pct for r in olap.demographics_share(year_star).collect()) == pytest.approx(100, abs=0.05)
    seasons = olap.product_by_season(year_star).collect()
    assert sum(r.Total_Sales for r in seasons) == pytest.approx(total(year_star))
    order = {"Spring": 1, "Summer": 2, "Fall": 3, "Winter": 4}
    assert [(r.Product_ID, r.Year, order[r.Season]) for r in seasons] == sorted((r.Product_ID, r.Year, order[r.Season]) for r in seasons)


def test_view(spark, year_star):
    olap.store_quarterly_sales(year_star)
    found = spark.sql(f"select Store_Name, sum(Quarterly_Sales) s, max(Unique_Customers) n from {olap.STORE_QUARTERLY_VIEW} group by 1").collect()
    assert sum(r.s for r in found) == pytest.approx(total(year_star))
    assert {r.n for r in found} == {4}


REPORTS = {
    "q1": lambda s: olap.top_products_by_day_type_monthly(s, 2017), "q2": olap.demographics_share,
    "q3": olap.category_by_occupation, "q4": lambda s: olap.gender_age_quarterly(s, 2017),
    "q5": olap.top_occupations_per_category, "q6": olap.city_marital_recent_months,
    "q7": olap.stay_and_gender_average, "q8": olap.top_cities_per_category,
    "q9": lambda s: olap.monthly_growth_by_category(s, 2017), "q10": lambda s: olap.weekend_share_by_age(s, 2017),
    "q12": lambda s: olap.store_quarterly_growth(s, 2017), "q13": olap.supplier_store_product,
    "q20": olap.store_quarterly_sales,
}


@pytest.mark.parametrize("name", REPORTS)
def test_large_dimensions_give_the_same_result(spark, year_star, name):
    """Without broadcast joins the reports sum per key before they join."""
    expected = rows(REPORTS[name](year_star))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(REPORTS[name](year_star)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
