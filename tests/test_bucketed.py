"""Reports on facts by customer: equal results, no shuffle of facts, copies that follow the loads."""

import os
import re
import shutil

import pytest
from conftest import rows
from fixtures import empty_warehouse, transactions

from tillstar import job, schemas
from tillstar.plans import bucketed, olap

REPORTS = [
    olap.demographics_share, olap.category_by_occupation, olap.top_occupations_per_category, olap.stay_and_gender_average,
    olap.top_cities_per_category,
]


@pytest.fixture(params=[None, 60], ids=["no hot customer", "hot customers"])
def star(spark, small_workspace, request, monkeypatch):
    w = small_workspace.full
    if request.param:
        monkeypatch.setattr(bucketed, "HOT_ROWS", request.param)
    shutil.rmtree(f"{w.root}/bucketed", ignore_errors=True)
    found = bucketed.star(w)
    assert len(found.fact_parts) == (2 if request.param else 1)
    return found


def test_reports_equal_those_on_plain_facts(small_workspace, star):
    for report in REPORTS:
        assert rows(report(star)) == rows(report(small_workspace.full.star))
    held = sum(p.count() for p in star.fact_parts)
    assert held == star.fact_sales.count()


def below(text, node):
    """The subtree of the first plan line that matches."""
    lines = text.splitlines()
    depth = lambda line: len(re.match(r"[ :+*\-]*", line)[0])
    at = next(k for k, line in enumerate(lines) if re.search(node, line))
    end = next((k for k in range(at + 1, len(lines)) if depth(lines[k]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at:end])


@pytest.mark.parametrize("report", REPORTS)
def test_facts_meet_customers_without_exchange(spark, small_workspace, report):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shutil.rmtree(f"{small_workspace.full.root}/bucketed", ignore_errors=True)
        star = bucketed.star(small_workspace.full)
        joined = below(report(star)._jdf.queryExecution().executedPlan().toString(), r"SortMergeJoin \[Customer_Key")
        assert "Exchange" not in joined and joined.count("Bucketed: true") == 2
        plain = below(report(small_workspace.full.star)._jdf.queryExecution().executedPlan().toString(), r"SortMergeJoin \[Customer_Key")
        assert "Exchange" in plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_copy_follows_the_loads(spark, tmp_path):
    w = empty_warehouse(spark, tmp_path / "w")
    w.append_sales(transactions(spark, [(1, 1, "A", 2, "2017-01-07"), (2, 2, "B", 1, "2017-05-01")]))
    assert job.star_for_reports(w).fact_parts == ()
    first = bucketed.build(w)
    assert bucketed.build(w) == first and job.star_for_reports(w).fact_parts
    w.append_sales(transactions(spark, [(3, 3, "C", 1, "2018-05-01")]))
    assert job.star_for_reports(w).fact_parts == ()  # not of the facts as they are now
    w.compact()
    bucketed.build(w)
    bucketed.clean(w)
    (name,) = os.listdir(f"{w.root}/bucketed")
    found = job.star_for_reports(w)
    assert name != first and rows(olap.category_by_occupation(found)) == rows(olap.category_by_occupation(w.star))
    # half-written copies do not count, and a session that does not know the tables enters them
    os.remove(f"{w.root}/bucketed/{name}/hot/_SUCCESS")
    assert bucketed.current(w) is None
    assert bucketed.build(w) == name
    for table in ("facts", "customers"):
        spark.sql(f"drop table {bucketed._table_name(f'{w.root}/bucketed/{name}/{table}')}")
    assert rows(olap.category_by_occupation(bucketed.star(w))) == rows(olap.category_by_occupation(w.star))
    schemas.drop_loads(spark, w.root)
    assert bucketed.current(w) is None
