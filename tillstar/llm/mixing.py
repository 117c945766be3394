"""Mixing sources to target weights: capped water-filling and seeded repetitions, in DataFrame operations only.

Sources in code point order (null last) weigh 3, 1, 2, 3, 1, 2, ... and share ``percent`` % of all words by weight.
A source gives at most ``epochs`` times its words: sources whose share is larger are clamped, and what they leave
over is shared again by weight until none is above. A document's size is its number of words.

A source with target t and size s repeats every document ``floor(t/s)`` times. For the rest of its target,
documents are taken once more in the order of md5(seed:doc_id) while the words before the document plus half of
the document fit: a seeded sample without replacement whose total is off by half a document at most, where
independent draws would be off by the spread of sizes. The order is not sorted as a whole: sizes are summed in
4096 ranges of the hash, and only the range in which the target ends is ranked document by document.

Results for special rows: a null text has no words; size 0 takes nothing. Rows with equal doc_id in a source share a
hash and are taken or left together. Rows without doc_id are kept, under the hash of an empty id. Sources without words
have target 0. One row is returned for each row; other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import WORD
from tillstar.session import stored

WEIGHTS = (3, 1, 2)
PERCENT = 150
EPOCHS = 2
SEED = "mix-1"


def word_count():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the seeded hash of each row."""
    hashed = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count().alias("size"), hashed.alias("hash"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size and target for a table of (source, source_size).

    Every round is one aggregate over the sources; rounds end when no further source is clamped, and each
    clamps at least one. Totals are whole numbers, so targets don't depend on the order of additions.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place.cast("int") + 1).cast("bigint")
    shares = stored(sources.select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.lit(epochs) * F.col("source_size")
    clamped = F.lit(False)
    held = -1
    while True:
        # in hundredths of a word: what is left for the sources that are not clamped, and their weights
        total = shares.agg(
            (F.sum("source_size") * percent - F.coalesce(F.sum(F.when(clamped, cap * 100)), F.lit(0))).alias("left"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count(F.when(clamped, 1)).alias("clamped"),
        ).first()
        left, weights_left = int(total["left"] or 0), int(total["weights"])
        share = F.col("weight") * F.lit(left).cast("double") / F.lit(100.0 * max(1, weights_left))
        if total["clamped"] == held or not weights_left:
            return shares.select("source", "source_size", F.when(clamped, cap.cast("double")).otherwise(share).alias("target"))
        held = total["clamped"]
        clamped = clamped | (share >= cap)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats and taken for each row of ``docs`` (doc_id, source, text)."""
    rows = stored(sizes(docs), "sizes")
    per_range = stored(
        rows.groupBy("source", F.substring("hash", 1, 3).alias("range")).agg(F.sum("size").alias("words")), "ranges"
    )
    goals = targets(per_range.groupBy("source").agg(F.sum("words").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = stored(goals.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "goals")

    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = per_range.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).join(goals, per_range.source.eqNullSafe(goals.source))
    ends = stored(ends.select(per_range.source, "range", "before", "words", "source_size", "target", "whole", "rest"), "ends")

    placed = rows.withColumn("range", F.substring("hash", 1, 3)).alias("r").join(
        ends.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.range") == F.col("e.range"))
    ).select("r.doc_id", "r.source", "r.size", "r.hash", "e.before", "e.words", "e.source_size", "e.target", "e.whole", "e.rest")
    fixed = ["doc_id", "source", "size", "source_size", "target"]
    open_range = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    within = Window.partitionBy("source").orderBy("hash").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ties = Window.partitionBy("source", "hash")
    ranked = (
        placed.where(open_range)
        .withColumn("together", F.sum("size").over(ties))
        .withColumn("reached", F.col("before") + F.sum("size").over(within))
        .withColumn("again", (F.col("reached") - F.col("together") / 2 <= F.col("rest")).cast("bigint"))
    )
    closed = placed.where(~open_range).withColumn("again", (F.col("before") < F.col("rest")).cast("bigint"))
    both = closed.select(*fixed, "whole", "again").unionByName(ranked.select(*fixed, "whole", "again"))
    repeats = (F.col("whole") + F.col("again")).cast("bigint")
    return both.select(*fixed, repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"))
