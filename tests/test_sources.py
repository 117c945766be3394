import datetime as dt

import pytest

from tillstar.sources import readers


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("index", [True, False])
@pytest.mark.parametrize("price", ["price$", "price"])
def test_products_with_and_without_index_and_price_name(spark, tmp_path, index, price):
    head = ("," if index else "") + f"Product_ID,Product_Category,{price},storeID,storeName,supplierID,supplierName\n"
    line = ("0," if index else "") + "P1,Toys,12.50,3,Store 3,9,Maker\n"
    df = readers.clean_products(readers.read_csv(spark, write(tmp_path / "p.csv", head + line)))
    assert [tuple(map(str, r)) for r in df.collect()] == [("P1", "Toys", "12.50", "3", "Store 3", "9", "Maker")]


@pytest.mark.parametrize("index", [True, False])
def test_transactions_by_position(spark, tmp_path, index):
    head = ("," if index else "") + "orderID,Customer_ID,Product_ID,quantity,date\n"
    body = [
        "1,10,P1,2,2017-03-04", "2,10,P1,x,2017-03-04", "3,10,P1,2,yesterday", "4,10,P1,0,2017-03-04 00:00:00",
        "abc,10,P1,2,2017-03-04", "6,,P1,2,2017-03-04",
    ]
    lines = "\n".join((f"{i}," if index else "") + row for i, row in enumerate(body)) + "\n"
    df = readers.clean_transactions(readers.read_csv(spark, write(tmp_path / "t.csv", head + lines)))
    found = [(r.Order_ID, r.Customer_ID, r.Quantity, r.Sale_Date, r.Unparsable) for r in df.collect()]
    day = dt.date(2017, 3, 4)
    assert found == [
        (1, 10, 2, day, False), (2, 10, None, day, True), (3, 10, 2, None, True), (4, 10, 0, day, False),
        (None, 10, 2, day, True), (6, None, 2, day, True),
    ]


def test_customers(spark, tmp_path):
    text = ",Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status\n0,7,F,0-17,10,A,4+,0\n"
    df = readers.clean_customers(readers.read_csv(spark, write(tmp_path / "c.csv", text)))
    assert [tuple(r) for r in df.collect()] == [(7, "F", "0-17", 10, "A", "4+", 0)]
