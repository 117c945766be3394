from conftest import rows
from fixtures import empty_warehouse, reasons, transactions
from pyspark.sql import functions as F

from tillstar.operators.dedupe import first_by_minimum, keep_first, repeated_keys, surplus_rows
from tillstar.plans import load

MIXED = [
    (1, 1, "A", 2, "2017-01-07"),      # a Saturday
    (1, 1, "A", 5, "2017-01-07"),      # same key, later by arrival
    (1, 1, "A", 5, "2017-01-07"),      # an exact copy
    (1, 1, "A", 2, "2017-01-08"),      # other date: another fact
    (2, 99, "A", 1, "2017-01-02"),     # customer above all masters
    (3, 0, "A", 1, "2017-01-02"),      # customer below all masters
    (4, 1, "Q", 1, "2017-01-02"),      # product
    (5, 1, "A", 1, "2016-12-31"),      # before the calendar
    (6, 1, "A", 0, "2017-01-02"),
    (7, 1, "A", -1, "2017-01-02"),
    (8, 1, "A", "x", "2017-01-02"),
    (9, 1, "A", 1, "someday"),
    (10, 99, "Q", 1, "2016-12-31"),    # several reasons: the customer comes first
]


def test_every_row_is_a_fact_or_a_reject(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path)
    w.load_sales(transactions(spark, MIXED))
    facts = w.table("fact_sales")
    found = rows(facts.select("Order_ID", "Quantity", "Date_Key", "Weekend_Flag", "Source_Rows", F.col("Net_Sales_Amount").cast("string")))
    assert found == [(1, 2, 20170107, 1, 3, "20.00"), (1, 2, 20170108, 1, 1, "20.00")]
    rejected = reasons(w.rejects())
    assert rejected == {
        "customer_not_found": 3, "product_not_found": 1, "date_out_of_calendar": 1, "quantity_not_positive": 2,
        "unparsable": 2, "duplicate": 2,
    }
    assert facts.count() + sum(rejected.values()) == len(MIXED)


def test_product_without_store_is_rejected(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path, product_rows=[("A", "T", "1.00", None, None, "7", "X"), ("B", "T", "1.00", "1", "S", None, None)])
    w.load_sales(transactions(spark, [(1, 1, "A", 1, "2017-01-01"), (2, 1, "B", 1, "2017-01-01")]))
    assert w.table("fact_sales").count() == 0
    assert reasons(w.rejects()) == {"store_not_found": 1, "supplier_not_found": 1}


def test_audit(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path)
    w.load_sales(transactions(spark, MIXED))
    audit = {r.Stage: (r.Rows_In, r.Rows_Out, r.Rate_Pct) for r in w.audit().collect()}
    assert audit["customer_join"] == (13, 10, 76.92)
    assert audit["end_to_end"] == (13, 2, 15.38)


def test_no_transactions(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path)
    w.load_sales(transactions(spark, MIXED).limit(0))
    audit = w.audit().collect()
    assert {(r.Rows_In, r.Rows_Out, r.Rate_Pct) for r in audit} == {(0, 0, None)}


def test_enrichment_is_inner(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path)
    tx = transactions(spark, MIXED[4:7] + MIXED[:1])
    both = load.enriched_sales(tx, w.table("master_customer"), w.table("master_product"))
    assert [(r.Order_ID, str(r.Total_Purchase)) for r in both.collect()] == [(1, "20.00")]


def test_surplus_complements_keep_first(spark):
    data = [(k, o, v) for k in range(20) for o, v in [(1, "a"), (1, "a"), (2, "b")][: k % 4]]
    data += [(7, 1, "a")] * 500 + [(7, i % 9, "z") for i in range(400)]
    df = spark.createDataFrame(data, "k long, o long, v string")
    first = keep_first(df, ["k"], "o", repeated_keys(df, ["k"]))
    assert rows(first) == rows(first_by_minimum(df, ["k"], "o").select(*first.columns))
    surplus = surplus_rows(df, ["k"], "o")
    expected = {}
    for row in sorted(data):
        expected[row] = expected.get(row, 0) + 1
    for k in {r[0] for r in data}:
        smallest = min(r for r in data if r[0] == k)
        expected[smallest] -= 1
    assert {(r.k, r.o, r.v): r.Copies for r in surplus.collect()} == {r: n for r, n in expected.items() if n}
    assert first.agg(F.sum("Source_Rows")).first()[0] == len(data)


def test_append_is_idempotent(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path)
    w.load_sales(transactions(spark, MIXED))
    more = [(1, 1, "A", 9, "2017-01-07"), (20, 2, "B", 1, "2018-03-01"), (20, 2, "B", 1, "2018-03-01"), (21, 99, "B", 1, "2018-03-01")]
    assert reasons(w.append_sales(transactions(spark, more))) == {"duplicate": 2, "customer_not_found": 1}
    assert w.table("fact_sales").count() == 3
    assert reasons(w.append_sales(transactions(spark, more))) == {"duplicate": 3, "customer_not_found": 1}
    assert w.table("fact_sales").count() == 3
    assert w.table("fact_sales").where("Order_ID = 1 and Date_Key = 20170107").first().Quantity == 2
