"""Compaction of many loads, and the saved quarters that follow it."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import rows
from fixtures import empty_warehouse, reasons, transactions

from tillstar import schemas
from tillstar.plans import load, olap, parts, quarters
from tillstar.streaming.fact_stream import FactStream

LOADS = [
    [(1, 1, "A", 2, "2017-01-07"), (2, 2, "B", 1, "2017-05-01"), (2, 2, "B", 1, "2017-05-01")],
    [(3, 3, "C", 1, "2018-05-01"), (1, 1, "A", 2, "2017-01-07"), (4, 1, "A", 1, "2017-02-01")],
    [(5, 99, "A", 1, "2017-02-01"), (6, 4, "D", 3, "2018-12-31")],
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    w = empty_warehouse(spark, tmp_path_factory.mktemp("built") / "w")
    for lines in LOADS:
        w.append_sales(transactions(spark, lines))
    return w.root


@pytest.fixture
def loaded(spark, tmp_path, built):
    """A copy of one warehouse with three loads."""
    shutil.copytree(built, tmp_path / "w")
    return empty_warehouse(spark, tmp_path / "w")


def facts(w):
    return rows(w.table("fact_sales").drop("Created_At"))


def folders(w, name="fact_sales"):
    return sorted(n for n in os.listdir(f"{w.root}/{name}") if not n.startswith("."))


def test_compaction_changes_no_row(loaded):
    w, before, rejected = loaded, facts(loaded), reasons(loaded.all_rejects())
    planned = w.table("fact_sales").drop("Created_At")
    w.compact()
    assert facts(w) == before and reasons(w.all_rejects()) == rejected
    assert rows(planned) == before  # a reader that planned earlier still finds its files
    assert len(parts.visible_loads(w.spark, f"{w.root}/fact_sales")) == 1
    # rows that are in the compacted facts are found as duplicates
    w.append_sales(transactions(w.spark, [*LOADS[0], (9, 1, "B", 1, "2017-07-07")]))
    assert len(facts(w)) == len(before) + 1
    w.compact()
    assert len(facts(w)) == len(before) + 1
    assert len(parts.visible_loads(w.spark, f"{w.root}/fact_sales")) == 1
    assert not any(n.startswith("Load_Batch=batch-") and n in folders(w) for n in parts.replaced_loads(w.spark, f"{w.root}/fact_sales"))


def test_a_killed_compaction_changes_nothing(loaded, monkeypatch):
    w, before = loaded, facts(loaded)

    def killed(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(parts, "publish", killed)
        with pytest.raises(OSError):
            w.compact()
    assert facts(w) == before
    assert any(n.startswith("_compacting-") for n in folders(w))
    w.compact()
    assert facts(w) == before and not any(n.startswith("_compacting-") for n in folders(w))


def test_the_newest_batch_of_a_stream_stays_its_own(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    stream = FactStream(w, w.root)
    for k, lines in enumerate(LOADS[1:]):
        stream.load_batch(transactions(spark, lines), k, "query")
    w.append_sales(transactions(spark, LOADS[0]))
    before, rejected = facts(w), reasons(w.all_rejects())
    w.compact()
    assert "query-1" in parts.visible_loads(spark, f"{w.root}/fact_sales")
    stream.load_batch(transactions(spark, LOADS[2]), 1, "query")  # runs again after a failure
    assert facts(w) == before and reasons(w.all_rejects()) == rejected


def report(w):
    return [tuple(r) for r in quarters.report(w.spark, w.root, w.table("dim_store")).collect()]


def test_saved_quarters_follow_the_loads(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    assert report(w) == []
    touched = []
    for lines in LOADS:
        w.append_sales(transactions(spark, lines))
        touched.append(quarters.refresh(spark, w.root))
        assert report(w) == [tuple(r) for r in olap.store_quarterly_sales(w.star).collect()]
    assert touched == [[(2017, 1), (2017, 2)], [(2017, 1), (2018, 2)], [(2018, 4)]]
    assert quarters.refresh(spark, w.root) == []
    w.compact()
    assert quarters.refresh(spark, w.root) == []  # the same rows in another folder: parts are added up, no quarter changes
    before = report(w)
    w.append_sales(transactions(spark, [(7, 2, "A", 1, "2017-01-09")]))
    assert quarters.refresh(spark, w.root) == [(2017, 1)]
    assert report(w) == [tuple(r) for r in olap.store_quarterly_sales(w.star).collect()] != before
    quarters.clean(spark, w.root)
    assert report(w) == [tuple(r) for r in olap.store_quarterly_sales(w.star).collect()]


def test_an_unfinished_version_is_not_read(loaded):
    quarters.refresh(loaded.spark, loaded.root)
    before = report(loaded)
    version = max(n for n in folders(loaded, "saved_quarters") if n.startswith("Version="))
    number = int(version.partition("=")[2])
    os.makedirs(f"{loaded.root}/saved_quarters/Version={number + 1}/_temporary/0")
    assert report(loaded) == before
    loaded.append_sales(transactions(loaded.spark, [(7, 2, "A", 1, "2017-01-09")]))
    assert quarters.refresh(loaded.spark, loaded.root) == [(2017, 1)]
    assert report(loaded) == [tuple(r) for r in olap.store_quarterly_sales(loaded.star).collect()] != before


def test_the_report_reads_neither_facts_nor_untouched_quarters(loaded):
    quarters.refresh(loaded.spark, loaded.root)
    read = quarters.report(loaded.spark, loaded.root, loaded.table("dim_store")).inputFiles()
    assert not any("fact_sales" in f or "quarter_parts" in f for f in read)


def test_the_audit_reads_only_what_the_writes_counted(loaded):
    assert all("load_audit" in f for f in loaded.audit().inputFiles())
    found = {r.Stage: (r.Rows_In, r.Rows_Out, r.Rate_Pct) for r in loaded.audit().collect()}
    # 8 lines, one without a customer, one repeated, one loaded before
    assert found["customer_join"] == (8, 7, 87.5) and found["end_to_end"] == (8, 5, 62.5)


def test_every_row_is_counted_when_it_is_written(loaded, tmp_path):
    w = loaded
    assert load.write_facts(w.table("fact_sales"), str(tmp_path / "copy")) == 5
    assert load.write_facts(w.table("fact_sales").limit(0), str(tmp_path / "none")) == 0


def test_queries_load_without_a_library_of_the_subpackage():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert found == ["73", "73"]


def test_layouts_name_what_a_rebuild_drops():
    assert set(schemas.DERIVED) == {"load_audit", quarters.PARTS, quarters.SAVED}
