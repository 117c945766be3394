import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators.keys import key_page, read_with_dense_key, write_sorted
from tillstar.plans import dims

PRODUCTS = "Product_ID string, Product_Category string, Price string, StoreID string, StoreName string, SupplierID string, SupplierName string"


def products(spark, rows):
    return spark.createDataFrame(rows, PRODUCTS).withColumn("Price", F.col("Price").cast(schemas.PRICE))


def test_calendar_of_2015_to_2020(spark):
    days = dims.dim_date(dims.years_between(spark))
    assert days.schema.names == schemas.DIM_DATE.names
    by_day = {r.Full_Date: r for r in days.collect()}
    assert len(by_day) == 2192
    first = by_day[dt.date(2016, 1, 1)]
    assert (first.Week_Number, first.Day_Name, first.Day_Of_Year, first.Fiscal_Year) == (53, "Friday", 1, 2015)
    leap = by_day[dt.date(2016, 2, 29)]
    assert (leap.Date_Key, leap.Day_Of_Year, leap.Month_Name, leap.Quarter_Label) == (20160229, 60, "February", "Q1")


def test_calendar_follows_the_data_and_is_empty_without_data(spark):
    days = spark.createDataFrame([(dt.date(1999, 5, 1),), (dt.date(2000, 1, 1),)], "d date")
    assert dims.dim_date(dims.years_of(days, "d")).count() == 365 + 366
    assert dims.dim_date(dims.years_of(days, "d", last=1999)).count() == 365
    assert dims.dim_date(dims.years_of(days.limit(0), "d")).count() == 0


def test_dense_keys_follow_key_order_over_many_files(spark, tmp_path):
    path = str(tmp_path / "sorted")
    ids = spark.range(0, 1000).select((F.col("id") * 7919 % 1000 * 3).alias("k"))
    ids.repartitionByRange(7, "k").sortWithinPartitions("k").write.parquet(path)
    numbered = read_with_dense_key(spark, path, "k", "n")
    assert [tuple(r) for r in numbered.orderBy("k").collect()] == [(i * 3, i + 1) for i in range(1000)]


def test_load_only_if_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    write_sorted(spark.range(3).toDF("k"), "k", path)
    write_sorted(spark.range(9).toDF("k"), "k", path)
    assert spark.read.parquet(path).count() == 3


def test_unknown_dimension_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        dims.load_dimension(spark, str(tmp_path), "dim_weather", str(tmp_path))


def test_master_key_is_made_unique(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d")], "k long, v string")
    assert sorted(tuple(r) for r in dims.unique_master(df, "k").collect()) == [(1, "a"), (2, "c")]


def test_store_and_supplier(spark):
    df = products(spark, [
        ("P1", "Toys", "59.99", "1", "S1", "9", "Z"),
        ("P2", "Toys", "60.002", "1", "S1", "9", "Z"),
        ("P3", "Food", "60.00", "1", "S1", "8", "Y"),
        ("P4", "Food", None, "1", "S1", "8", "Y"),
        ("P5", "Toys", "1.00", "1", "S1", "8", "Y"),
        ("P6", "Toys", "1.00", "1", "S1", "8", "Y"),
        ("P7", "Food", "1.00", None, "S1", None, None),
    ])
    store = dims.stores(df).collect()[0]
    assert (store.SKU_Count, store.Category_Count, str(store.Avg_List_Price)) == (6, 2, "36.40")
    by_supplier = {r.Supplier_ID: r for r in dims.suppliers(df).collect()}
    assert set(by_supplier) == {"8", "9"}
    assert by_supplier["8"].Primary_Category == "Food"  # two of each: first by name
    assert (by_supplier["9"].Primary_Category, str(by_supplier["9"].Avg_List_Price)) == ("Toys", "60.00")


def test_average_just_below_flagship_rounds_up(spark):
    # 59.99 + 60.00 + 60.00 = 179.99 / 3 = 59.9967
    df = products(spark, [(f"P{i}", "T", p, "1", "S", "1", "M") for i, p in enumerate(["59.99", "60.00", "60.00"])])
    keyed = dims.stores(df).withColumn("Store_Key", F.lit(1))
    row = dims.dim_store(keyed).first()
    assert (str(row.Avg_List_Price), row.Is_Flagship, row.Store_Tier, row.Is_Active) == ("60.00", 1, "Compact", 1)


def test_page(spark):
    page = key_page(spark.range(100).toDF("k"), "k", 40, 5)
    assert [r.k for r in page.collect()] == [40, 41, 42, 43, 44]


def test_recreate_tables(spark, tmp_path):
    schemas.recreate_tables(spark, str(tmp_path))
    for name, layout in schemas.MASTER_TABLES.items():
        assert spark.read.schema(layout).parquet(f"{tmp_path}/{name}").count() == 0
    assert spark.read.schema(schemas.FACT_SALES).parquet(f"{tmp_path}/fact_sales").count() == 0
