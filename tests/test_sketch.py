from pyspark.sql import functions as F

from tillstar.operators import profile


def test_the_estimate_is_near_for_unlucky_keys_too(spark):
    """Keys that a sketch of 2^14 registers misjudges by 2.01 %."""
    df = spark.range(300_000).select((F.col("id") + 67_000_000).alias("k"), (F.col("id") % 3).alias("day"))
    row = profile.sketch_check(df, profile.distinct_sketches(df, "day", ["k"]), ["k"]).first()
    assert (row.Distinct_Values, row.Sketch_Is_Near) == (300_000, 1)
    assert 4 * 104 <= 2 * 2 ** (profile.SKETCH_BITS / 2)  # 2 % are at least four standard errors of 1.04 / sqrt(registers)
