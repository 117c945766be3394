"""The most frequent keys, exactly, without a shuffle of all keys.

1. A frequent-items sketch of bounded size names the likely keys. Sketches are built by every task and merged; those of
   several loads merge as well (``merged``).
2. One pass counts the likely keys exactly, and all other rows by hash in ``BUCKETS`` buckets. A key occurs at most as
   often as its bucket.
3. Only the keys of buckets that reach the count of the last likely key in the result are counted one by one. If
   some keys stand out there are few such buckets or none; if none does, all keys are counted, as they have to be.

So the result never rests on the sketch's estimates, and a task sends ``CANDIDATES`` + ``BUCKETS`` rows at most in step 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.session import stored

TRACKED = 10_000  # keys that a sketch holds
CANDIDATES = 1_000  # of them, counted exactly
BUCKETS = 1 << 16


def key_sketch(df: DataFrame, key: str) -> DataFrame:
    """One row with the sketch of the non-null keys."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).agg(F.expr(f"approx_top_k_accumulate(k, {TRACKED})").alias("sketch"))


def merged(sketches: DataFrame) -> DataFrame:
    """One sketch of all rows of several ones."""
    return sketches.agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))


def likely_keys(sketch: DataFrame) -> DataFrame:
    """(k): the ``CANDIDATES`` keys at most that are likely to be the most frequent."""
    return sketch.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {CANDIDATES})"))).where("item is not null").select(F.col("item").alias("k"))


def top_keys(df: DataFrame, key: str, top: int, sketch: DataFrame | None = None) -> DataFrame:
    """The ``top`` most frequent keys with their ``Row_Count``; ties go to the smaller key, null keys do not count."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    likely = stored(likely_keys(key_sketch(df, key) if sketch is None else sketch), "likely_keys")
    counted = stored(_counted(rows, likely), "key_counts")
    known = counted.where("k is not null").select("k", "Row_Count")
    order = (F.desc("Row_Count"), "k")
    held, least = known.orderBy(*order).limit(top).agg(F.count(F.lit(1)), F.min("Row_Count")).first()
    reaching = stored(counted.where(F.col("k").isNull() & (F.col("Row_Count") >= (least if held == top else 0))).select("bucket"), "open_buckets")
    if not reaching.isEmpty():
        known = known.unionByName(_counted_in(rows, reaching, likely))
    return known.orderBy(*order).limit(top).withColumnRenamed("k", key)


def _bucket():
    return F.pmod(F.xxhash64("k"), F.lit(BUCKETS))


def _counted(rows: DataFrame, likely: DataFrame) -> DataFrame:
    """(k, bucket, Row_Count): rows per likely key, and rows of all other keys per bucket (k is null)."""
    marked = rows.join(F.broadcast(likely.withColumn("likely", F.lit(True))), "k", "left")  # CANDIDATES rows at most
    other = F.col("likely").isNull()
    return marked.groupBy(F.when(~other, F.col("k")).alias("k"), F.when(other, _bucket()).alias("bucket")).agg(F.count(F.lit(1)).alias("Row_Count"))


def _counted_in(rows: DataFrame, buckets: DataFrame, likely: DataFrame) -> DataFrame:
    """(k, Row_Count) of the keys of some buckets that are not likely ones."""
    inside = rows.withColumn("bucket", _bucket()).join(F.broadcast(buckets), "bucket", "left_semi")  # BUCKETS rows at most
    return inside.join(F.broadcast(likely), "k", "left_anti").groupBy("k").agg(F.count(F.lit(1)).alias("Row_Count"))
