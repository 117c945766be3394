"""Quantiles of values that lie very unevenly."""

import statistics

import pytest
from pyspark.sql import functions as F

from tillstar.operators import profile


def quartiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "Price double").select(F.col("Price").cast("decimal(12,2)").alias("Price"))
    row = profile.summary(df, "Price").first()
    return [row.Quartile_1, row.Median, row.Quartile_3]


@pytest.mark.parametrize("few", [4, 100])
def test_an_outlier_is_narrowed_down(spark, monkeypatch, few):
    monkeypatch.setattr(profile, "FEW", few)
    monkeypatch.setattr(profile, "RANGES", 16)
    seen = []
    ranges = profile._counted_ranges
    monkeypatch.setattr(profile, "_counted_ranges", lambda *a: seen.append(ranges(*a)) or seen[-1])
    values = [k / 100 for k in range(1, 3000)] + [10.0**9] + [5.0] * 500
    assert quartiles(spark, values) == [round(q, 6) for q in statistics.quantiles(values, n=4, method="inclusive")]
    assert len(seen) > 3 and all(len(r) <= 17 for r in seen)  # every count is small, however the values lie


def test_few_values(spark):
    for values in ([1.0], [1.0, 2.0], [3.0] * 9, [0.0, 10.0**9, 10.0**9]):
        expected = statistics.quantiles(values, n=4, method="inclusive") if len(values) > 1 else values * 3
        assert quartiles(spark, values) == expected
