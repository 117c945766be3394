"""The most frequent keys against a plain count."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillstar.operators import frequent


def plain(values, top):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda p: (-p[1], p[0]))[:top]


def found(df, top, **more):
    return [tuple(r) for r in frequent.top_keys(df, "bucket", top, **more).collect()]


@pytest.fixture
def small(monkeypatch):
    for name, value in {"TRACKED": 64, "CANDIDATES": 16, "BUCKETS": 128}.items():
        monkeypatch.setattr(frequent, name, value)


@pytest.fixture
def counted_one_by_one(monkeypatch):
    """Rows that step 3 counts, by call."""
    seen = []
    work = frequent._counted_in
    monkeypatch.setattr(frequent, "_counted_in", lambda *a: seen.append(work(*a).count()) or work(*a))
    return seen


def test_keys_that_stand_out(spark, small, counted_one_by_one):
    """A key with a third of all rows and some frequent ones among 30,000 that occur once or twice."""
    values = [7] * 30_000 + [k for k in range(10) for _ in range(2_000 + k)] + [k % 30_000 for k in range(100, 40_100)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "bucket long").repartition(8)
    assert found(df, 10) == plain(values, 10)
    assert counted_one_by_one == []  # no other key left its task
    assert frequent._counted(df.select(F.col("bucket").alias("k")).where("k is not null"), frequent.likely_keys(frequent.key_sketch(df, "bucket"))).count() <= 128 + 16


def test_keys_that_do_not(spark, small, counted_one_by_one):
    """All keys are alike: the sketch knows nothing, the result is still exact, with ties by key."""
    values = [f"k{k:05d}" for k in range(3_000) for _ in range(3 + (k % 700 == 5))]
    df = spark.createDataFrame([(v,) for v in values], "bucket string")
    assert found(df, 10) == plain(values, 10)
    assert counted_one_by_one


def test_sketches_of_loads_merge(spark, small):
    parts = [[1] * 500 + list(range(100, 900)), [2] * 700 + list(range(200, 700)), [1] * 300, []]
    frames = [spark.createDataFrame([(v,) for v in p], "bucket long") for p in parts]
    whole, sketches = frames[0], frequent.key_sketch(frames[0], "bucket")
    for more in frames[1:]:
        whole, sketches = whole.unionByName(more), sketches.unionByName(frequent.key_sketch(more, "bucket"))
    assert found(whole, 2, sketch=frequent.merged(sketches)) == [(1, 800), (2, 700)]


def test_few_or_no_keys(spark, small):
    kind = "bucket long, likely int"
    assert found(spark.createDataFrame([], kind), 5) == []
    assert found(spark.createDataFrame([(None, 1), (None, 2)], kind), 5) == []
    assert found(spark.createDataFrame([(3, 1), (2, 1), (3, 2)], kind), 5) == [(3, 2), (2, 1)]
