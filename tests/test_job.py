import csv

import pytest
from conftest import rows

from tillstar import job


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")

    def save(name, head, lines):
        (folder / name).parent.mkdir(exist_ok=True)
        with open(folder / name, "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(["", *head])
            writer.writerows([i, *line] for i, line in enumerate(lines))
        return str(folder / name)

    customers = save(
        "customers.csv",
        ["Customer_ID", "Gender", "Age", "Occupation", "City_Category", "Stay_In_Current_City_Years", "Marital_Status"],
        [(i, "MF"[i % 2], "26-35", i % 21, "ABC"[i % 3], "4+" if i % 5 == 4 else i % 5, i % 2) for i in range(30)],
    )
    products = save(
        "products.csv",
        ["Product_ID", "Product_Category", "price$", "storeID", "storeName", "supplierID", "supplierName"],
        [(f"P{i:02d}", "Toys" if i % 2 else "Food", i * 5 + 0.5, i % 3, f"S{i % 3}", i % 2, f"M{i % 2}") for i in range(20)],
    )
    head = ["orderID", "Customer_ID", "Product_ID", "quantity", "date"]
    for part in range(2):
        save(
            f"tx/part{part}.csv", head,
            [(o, o % 32, f"P{o % 20:02d}", 1 + o % 4, f"{2017 + o % 2}-{1 + o % 12:02d}-{1 + o % 28:02d}")
             for o in range(part * 200, part * 200 + 200)],
        )
    return customers, products, str(folder / "tx")


def test_csv_to_reports_in_batch_and_stream(spark, files, tmp_path):
    batch = job.etl(spark, *files, str(tmp_path / "batch"))
    stream = job.etl(spark, *files, str(tmp_path / "stream"), stream=True)
    assert batch.table("fact_sales").count() == 376  # customers 30 and 31 do not exist
    for name in ("q02", "q13", "q17", "q18"):
        make = job.REPORTS[name]
        assert rows(make(batch.star, 2017, (2017, 2018))) == rows(make(stream.star, 2017, (2017, 2018)))
    again = job.etl(spark, *files, str(tmp_path / "stream"), stream=True)
    assert again.table("fact_sales").count() == 376
    for name, make in job.REPORTS.items():
        assert make(batch.star, 2017, (2017, 2018)).columns, name


def test_analysis(spark, files):
    found = job.analysis(spark, *files)
    assert rows(found["orphan_customers"]) == [("example", "30"), ("example", "31"), ("orphan_keys", "2")]
    assert rows(found["orphan_products"]) == [("orphan_keys", "0")]
    assert rows(found["reconciliation"]) == [(400, 376, 24)]
    assert rows(found["key_uniqueness"]) == [
        ("customers", "Customer_ID", 30, 30, 0, 1), ("products", "Product_ID", 20, 20, 0, 1),
    ]
    price = found["price"].first()
    assert (price.Value_Count, price.Mean, price.Minimum, price.Median, price.Maximum) == (20, 48.0, 0.5, 48.0, 95.5)
    assert rows(found["quantities"]) == [(1, 100), (2, 100), (3, 100), (4, 100)]
    assert found["joined_head"].count() == 5
    assert rows(found["multi_product_orders"]) == []


def test_report_command_writes_files(spark, files, tmp_path):
    root = str(tmp_path / "w")
    job.etl(spark, *files, root)
    job.main(["report", "--warehouse", root, "--year", "2017", "--output", str(tmp_path / "out"), "q10", "q12"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "q12")).count() > 0
