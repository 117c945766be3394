import os
import time

import pytest
from conftest import SMALL, rows
from fixtures import empty_warehouse, reasons, transactions
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillstar import catalog, schemas
from tillstar.plans.star import Workspace
from tillstar.session import release
from tillstar.streaming.fact_stream import FactStream, batch_rates, transaction_stream

FIRST = [(1, 1, "A", 2, "2017-01-07"), (1, 1, "A", 2, "2017-01-07"), (2, 2, "B", 1, "2017-05-01"), (3, 77, "B", 1, "2017-05-01")]
SECOND = [(2, 2, "B", 1, "2017-05-01"), (4, 3, "C", 1, "2018-02-01"), (5, 1, "A", 0, "2018-02-01")]
COLUMNS = ["Order_ID", "Product_Key", "Date_Key", "Quantity", "Customer_Key"]


def add_csv(spark, folder, lines, index=True):
    """One file, as the source writes it: a blank header over a running number."""
    kinds = "n string, " + ", ".join(f"{c} string" for c in schemas.RAW_TRANSACTION_FIELDS)
    df = spark.createDataFrame([(str(i), *map(str, r)) for i, r in enumerate(lines)], kinds).coalesce(1)
    df.write.mode("append").option("header", True).csv(str(folder))


def layout():
    return schemas.RAW_TRANSACTION.__class__([schemas.RAW_TRANSACTION[0].__class__("_c0", schemas.RAW_TRANSACTION[0].dataType), *schemas.RAW_TRANSACTION.fields])


def run(loader, spark, folder, checkpoint=None):
    stream = transaction_stream(spark, str(folder), layout(), "csv", files_per_batch=1)
    query = loader.start(stream, checkpoint)
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_survives_restart_and_replay(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    folder, loader = tmp_path / "in", FactStream(w, str(tmp_path / "out"))
    add_csv(spark, folder, FIRST)
    run(loader, spark, folder)
    assert rows(loader.facts().select("Order_ID", "Quantity", "Source_Rows")) == [(1, 2, 2), (2, 1, 1)]
    assert reasons(loader.rejects()) == {"duplicate": 1, "customer_not_found": 1}

    add_csv(spark, folder, SECOND)
    run(loader, spark, folder)  # goes on behind the first file
    batch = empty_warehouse(spark, tmp_path / "b")
    batch.load_sales(transactions(spark, FIRST + SECOND))
    expected = rows(batch.table("fact_sales").select(*COLUMNS))
    assert rows(loader.facts().select(*COLUMNS)) == expected
    assert reasons(loader.rejects()) == {"duplicate": 2, "customer_not_found": 1, "quantity_not_positive": 1}
    assert reasons(batch.rejects()) == reasons(loader.rejects())

    run(loader, spark, folder)  # nothing new
    assert rows(loader.facts().select(*COLUMNS)) == expected


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    loader = FactStream(w, str(tmp_path / "out"))
    loader.load_batch(transactions(spark, FIRST), 0)
    loader.load_batch(transactions(spark, SECOND), 1)
    facts, rejected = rows(loader.facts().select(*COLUMNS)), reasons(loader.rejects())
    loader.load_batch(transactions(spark, SECOND), 1)
    assert rows(loader.facts().select(*COLUMNS)) == facts
    assert reasons(loader.rejects()) == rejected


def test_a_new_checkpoint_keeps_old_facts_and_adds_none_twice(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    folder, loader = tmp_path / "in", FactStream(w, str(tmp_path / "out"))
    add_csv(spark, folder, FIRST)
    run(loader, spark, folder, str(tmp_path / "one"))
    assert loader.facts().count() == 2
    add_csv(spark, folder, SECOND)
    run(loader, spark, folder, str(tmp_path / "two"))
    assert rows(loader.facts().select("Order_ID")) == [(1,), (2,), (4,)]
    assert loader.rejects().where("Reason = 'duplicate'").agg(F.sum("Copies")).first()[0] == 1 + 3 + 1
    found = {r.Stage: (r.Rows_In, r.Rows_Out) for r in loader.audit().collect()}
    assert found["end_to_end"] == (4 + 7, 3) and found["customer_join"] == (11, 9)


def test_batch_and_stream_share_a_folder(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    w.append_sales(transactions(spark, FIRST))
    loader = FactStream(w, w.root)
    loader.load_batch(transactions(spark, SECOND), 0)
    w.append_sales(transactions(spark, [*FIRST, (9, 1, "A", 1, "2017-01-08")]))
    assert rows(w.table("fact_sales").select("Order_ID")) == [(1,), (2,), (4,), (9,)]
    assert reasons(w.all_rejects()) == {"duplicate": 1 + 1 + 3, "customer_not_found": 2, "quantity_not_positive": 1}


def test_no_rows(spark, tmp_path):
    loader = FactStream(empty_warehouse(spark, tmp_path / "w"), str(tmp_path / "out"))
    assert loader.facts().count() == 0
    loader.load_batch(transactions(spark, FIRST).limit(0), 0)
    assert loader.facts().count() == 0


def test_a_recreated_warehouse_is_loaded_again(spark, tmp_path):
    root, folder = str(tmp_path / "w"), tmp_path / "in"
    add_csv(spark, folder, FIRST)
    for _ in range(2):
        schemas.recreate_tables(spark, root)
        loader = FactStream(empty_warehouse(spark, root), root)
        assert loader.facts().count() == 0
        run(loader, spark, folder)
        assert rows(loader.facts().select("Order_ID", "Quantity")) == [(1, 2), (2, 1)]
        found = {r.Stage: (r.Rows_In, r.Rows_Out) for r in loader.audit().collect()}
        assert found["end_to_end"] == (4, 2)


def test_a_checkpoint_of_other_facts_is_refused(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    add_csv(spark, folder, FIRST)
    root = str(tmp_path / "w")
    run(FactStream(empty_warehouse(spark, root), root), spark, folder, checkpoint)
    run(FactStream(empty_warehouse(spark, root), root), spark, folder, checkpoint)  # its own one may go on
    schemas.recreate_tables(spark, root)
    with pytest.raises(ValueError, match="belongs to other facts"):
        run(FactStream(empty_warehouse(spark, root), root), spark, folder, checkpoint)


def test_batches_are_bounded_by_bytes_and_files_are_archived(spark, tmp_path):
    folder, archive, sizes = tmp_path / "in", tmp_path / "done", [1, 2, 400, 3, 1000, 5, 700, 2, 300, 2000, 1, 600]
    folder.mkdir()
    order = 0
    for k, size in enumerate(sizes):
        lines = [f"{i},{order + i},{i % 3},{'ABC'[i % 3]},1,2017-01-07" for i in range(size)]
        order += size
        (folder / f"{k:02d}.csv").write_text("\n".join([",orderID,Customer_ID,Product_ID,quantity,date", *lines, ""]))
        time = 1_500_000_000 + k
        os.utime(folder / f"{k:02d}.csv", (time, time))
    names = {f.name: f.stat().st_size for f in folder.glob("*.csv")}
    bound = max(names.values())
    root = str(tmp_path / "w")
    kinds = StructType([StructField(c, StringType()) for c in ("_c0", "orderID", "Customer_ID", "Product_ID", "quantity", "date")])
    loader = FactStream(empty_warehouse(spark, root), root)

    def load():
        query = loader.start(transaction_stream(spark, str(folder), kinds, "csv", bytes_per_batch=bound, archive=str(archive)))
        query.awaitTermination()
        return [r.Rows_In for r in batch_rates(spark, query).orderBy("Batch").collect()]

    read = load()
    assert sum(read) == sum(sizes) and max(read) <= 2 * max(sizes)
    assert 1 < len(read) < len(sizes)  # large files apart, small ones together
    assert loader.facts().count() + sum(reasons(loader.rejects()).values()) == sum(sizes)
    assert load() == [] and list(archive.rglob("*.csv"))  # a restart reads nothing again
    assert {f.name for f in [*archive.rglob("*.csv"), *folder.glob("*.csv")]} == set(names)


def test_batches_do_not_become_more_with_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        w = Workspace(spark, SMALL)
        found = {r.Stage: (r.Rows_In, r.Rows_Out) for r in catalog._streamed(w).audit().collect()}
        facts = catalog.stream_fact_load(w).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(spark.read.parquet(w.landing).inputFiles()) == 60
    assert [len([n for n in os.listdir(f"{folder}_checkpoint/commits") if n.isdigit()]) for folder in (w.landing, w.late)] == [3, 1]
    lines = spark.read.parquet(w.landing).count() + spark.read.parquet(w.late).count()
    assert found["end_to_end"] == (lines, facts)


def test_a_batch_leaves_no_shuffle_behind(spark, tmp_path):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    folder, loader = tmp_path / "in", FactStream(empty_warehouse(spark, tmp_path / "w"), str(tmp_path / "out"))
    add_csv(spark, folder, FIRST)
    release(spark)
    time.sleep(2)  # the cleaner works behind the collector
    before = tracker.shuffleStatuses().size()
    query = run(loader, spark, folder)
    time.sleep(2)
    assert query.lastProgress.numInputRows == len(FIRST)
    assert tracker.shuffleStatuses().size() <= before + 3  # those of the query's last plan
