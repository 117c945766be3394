"""The pairs of items that most baskets contain together, exactly, without pairing up huge baskets.

Baskets of up to ``SMALL_BASKET`` rows are paired by a self-join: each row meets a bounded number of
others. Larger baskets (few by nature: at most rows / SMALL_BASKET) are never paired as they are:

* The pair counts of the small baskets give a threshold that any pair of the result must reach.
* A pair that small baskets know is looked up in the large ones only if its count there could lift it
  to the threshold; its count is bounded by the rarer item's number of large baskets.
* Other pairs live on large baskets alone, so both items must be in at least that many large baskets.
  Items that occur in the same large baskets form a class. Only classes are paired, so one giant basket
  is a single class. Within a pair of classes all pairs have the same count, and ties go to the
  smallest items, so the first ``top + 1`` items of a class are enough. A basket with many classes is dealt
  into chunks of about ``CHUNK`` items; every two chunks meet in a key of their own, so no task pairs a whole basket.

Before that, the pairs among the most frequent items give a first threshold:
items that occur less often than that cannot be in a result pair and leave before any pairing.

Lines are dealt by basket, and pairs by themselves, into as many partitions as their counted numbers ask for, so the memory
of a task does not grow with the table, whatever number of shuffle partitions is set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.skew import HOT_SHARE, join_repeated
from tillstar.session import as_lookup, stored

SMALL_BASKET = 100
CHUNK = 500
LINES_PER_TASK = 500_000
PAIRS_PER_TASK = 500_000
SLOTS_PER_TASK = 32  # parts of the baskets that are dealt to a task, so that tasks are of one size
PRUNED_SHARE = 10  # of the lines, at least a tenth has to leave: dropping rare items shuffles all lines by item
PROBE_PAIRS = 1000
PROBE_ITEMS = 200


def top_pairs(
    lines: DataFrame, basket: str, item: str, top: int, small_basket: int = SMALL_BASKET, prune: bool = True
) -> DataFrame:
    """Columns ``First`` < ``Second`` and ``Baskets``; order: most baskets, then smallest items.

    ``prune`` drops rare items first; without it (for tests) the result is the same.
    """
    lines = lines.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    lines, rows = _without_rare_items(lines, top) if prune else (lines, lines.count())
    sizes = _dealt(lines, rows // LINES_PER_TASK, "basket").groupBy("basket").agg(F.count(F.lit(1)).alias("rows"))
    is_large, pairs = F.col("rows") > small_basket, F.expr("rows * (rows - 1) div 2")
    large = sizes.where(is_large)
    large_baskets, small_pair_rows = sizes.agg(F.count_if(is_large), F.sum(F.when(~is_large, pairs))).first()
    tasks = max(rows // LINES_PER_TASK, (small_pair_rows or 0) // PAIRS_PER_TASK)
    if not large_baskets:
        return _best(_pair_counts(lines, tasks), top)

    large = stored(large, "large_baskets")
    small_pairs = stored(_pair_counts(_without(lines, large), tasks), "small_pairs")
    in_large = join_repeated(lines, large, ["basket"], "rows").select("basket", "item").distinct()
    large_lines = stored(in_large, "large_lines")
    support = stored(large_lines.groupBy("item").agg(F.count(F.lit(1)).alias("support")), "support")

    threshold = _reached(small_pairs, top)
    bounded = _with_bound(small_pairs.where(F.col("Baskets") + large_baskets >= threshold), support)
    probe = bounded.orderBy(F.desc("bound"), "First", "Second").limit(max(PROBE_PAIRS, top))
    threshold = max(threshold, _reached(_add_large(probe, large_lines), top), 1)

    known = _add_large(bounded.where(F.col("bound") >= threshold), large_lines)
    unknown = _class_pairs(large_lines, support, threshold, top)
    both = known.unionByName(unknown).groupBy("First", "Second").agg(F.max("Baskets").alias("Baskets"))
    return _best(both, top)


def _without_rare_items(lines: DataFrame, top: int) -> tuple[DataFrame, int]:
    """Rows whose item occurs at least as often as the ``top``-th pair among the most frequent items, and their number; all rows
    if few would leave."""
    counts = stored(lines.groupBy("item").agg(F.count(F.lit(1)).alias("rows")), "item_counts")
    frequent = counts.orderBy(F.desc("rows"), "item").limit(PROBE_ITEMS)
    probed_rows = frequent.agg(F.sum("rows")).first()[0] or 0
    # at most PROBE_ITEMS items, so even the largest basket has a bounded number of pairs here, and all have few different ones
    probed = lines.join(F.broadcast(frequent.select("item")), "item", "left_semi")
    threshold = _reached(_pairs(_baskets(probed, probed_rows // LINES_PER_TASK)).groupBy("First", "Second").agg(F.count(F.lit(1)).alias("Baskets")), top)
    is_kept = F.col("rows") >= threshold
    rows, kept = (n or 0 for n in counts.agg(F.sum("rows"), F.sum(F.when(is_kept, F.col("rows")))).first())
    if (rows - kept) * PRUNED_SHARE <= rows:
        return lines, rows
    return lines.join(as_lookup(counts.where(is_kept).select("item")), "item", "left_semi"), kept


def _dealt(rows: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows placed by ``keys`` in as many partitions, one per core at least."""
    return rows.repartition(max(tasks + 1, rows.sparkSession.sparkContext.defaultParallelism), *keys)


def _baskets(lines: DataFrame, tasks: int) -> DataFrame:
    """The different items of each basket, in order; baskets with a bounded number of them. A ``slot`` of baskets is in one task."""
    slots = SLOTS_PER_TASK * (tasks + 1)
    dealt = _dealt(lines.withColumn("slot", F.pmod(F.xxhash64("basket"), F.lit(slots))), tasks, "slot")
    return dealt.groupBy("slot", "basket").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _pairs(baskets: DataFrame) -> DataFrame:
    rest = F.slice("items", F.col("place") + 2, F.size("items"))
    return (
        baskets.where(F.size("items") > 1)
        .select("slot", "items", F.posexplode("items").alias("place", "First"))
        .select("slot", "First", F.explode(rest).alias("Second"))
    )


def _best(pairs: DataFrame, top: int) -> DataFrame:
    return pairs.orderBy(F.desc("Baskets"), "First", "Second").limit(top)


def _reached(pairs: DataFrame, top: int) -> int:
    """The count that ``top`` of these pairs reach; 0 when there are fewer pairs."""
    counts = [row.Baskets for row in _best(pairs, top).select("Baskets").collect()]  # at most ``top`` rows
    return min(counts) if len(counts) == top else 0


def _pair_counts(lines: DataFrame, tasks: int) -> DataFrame:
    """Lines of small baskets. A pair is counted in its slot first, without a shuffle, so one that very many baskets hold costs a
    row per slot."""
    by_slot = _pairs(_baskets(lines, tasks)).groupBy("slot", "First", "Second").agg(F.count(F.lit(1)).alias("n"))
    return _dealt(by_slot.drop("slot"), tasks, "First", "Second").groupBy("First", "Second").agg(F.sum("n").alias("Baskets"))


def _pair_counts_in_chunks(lines: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``_pair_counts`` for distinct rows of large baskets: a pair meets once, in the cell of its two chunks."""
    sizes = lines.groupBy("basket").agg(F.count(F.lit(1)).alias("rows"))
    slots = F.ceil(F.col("rows") / chunk)
    own = F.pmod(F.xxhash64("item"), F.col("slots"))
    dealt = join_repeated(lines, sizes, ["basket"], "rows").select("basket", "item", slots.alias("slots"))
    cells = (
        dealt.select("basket", "item", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1)).alias("other"))
        .select("basket", "item", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    first, second = cells.withColumnsRenamed({"item": "First", "own": "a"}), cells.withColumnsRenamed({"item": "Second", "own": "b"})
    met = first.join(second, ["basket", "low", "high"]).where("First < Second and (a <> b or low = high)")
    return met.groupBy("First", "Second").agg(F.count(F.lit(1)).alias("Baskets"))


def _without(lines: DataFrame, large: DataFrame) -> DataFrame:
    """Rows of small baskets. The largest baskets (fewer than ``HOT_SHARE``) leave by broadcast, so the
    join that removes the others has no hot key."""
    total = lines.agg(F.count(F.lit(1)))
    giants = large.where(F.col("rows") * HOT_SHARE > total.scalar()).select("basket")
    return lines.join(F.broadcast(giants), "basket", "left_anti").join(large.select("basket"), "basket", "left_anti")


def _with_bound(pairs: DataFrame, support: DataFrame) -> DataFrame:
    """Adds the rarer item's large-basket count to get an upper ``bound``; ``Rare`` is that item."""
    first = support.select(F.col("item").alias("First"), F.col("support").alias("first_support"))
    second = support.select(F.col("item").alias("Second"), F.col("support").alias("second_support"))
    joined = pairs.join(first, "First", "left").join(second, "Second", "left").na.fill(
        0, ["first_support", "second_support"]
    )
    first_rarer = F.col("first_support") <= F.col("second_support")
    return joined.select(
        "First", "Second", "Baskets",
        (F.col("Baskets") + F.least("first_support", "second_support")).alias("bound"),
        F.when(first_rarer, F.col("First")).otherwise(F.col("Second")).alias("Rare"),
        F.when(first_rarer, F.col("Second")).otherwise(F.col("First")).alias("Other"),
    )


def _add_large(pairs: DataFrame, large_lines: DataFrame) -> DataFrame:
    """Small-basket counts plus the exact counts in large baskets."""
    shared = (
        pairs.where(F.col("bound") > F.col("Baskets"))
        .join(large_lines.withColumnRenamed("item", "Rare"), "Rare")
        .join(large_lines.withColumnRenamed("item", "Other"), ["basket", "Other"])
        .groupBy("First", "Second")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    total = F.col("Baskets") + F.coalesce("shared", F.lit(0))
    return pairs.join(shared, ["First", "Second"], "left").select("First", "Second", total.alias("Baskets"))


def _class_pairs(large_lines: DataFrame, support: DataFrame, threshold: int, top: int) -> DataFrame:
    frequent = large_lines.join(support.where(F.col("support") >= threshold).select("item"), "item")
    # which large baskets an item is in, as two independent 64-bit sums
    classes = frequent.groupBy("item").agg(
        F.count(F.lit(1)).alias("support"),
        F.sum(F.xxhash64("basket").cast("decimal(20,0)")).alias("sum_of_hashes"),
        F.bit_xor(F.xxhash64("basket", F.lit(1))).alias("xor_of_hashes"),
    )
    signature = ["support", "sum_of_hashes", "xor_of_hashes"]
    place = F.row_number().over(Window.partitionBy(*signature).orderBy("item"))
    members = classes.withColumn("place", place).where(F.col("place") <= top + 1)
    leaders = members.where("place = 1").select(F.col("item").alias("leader"), *signature)
    named = members.join(leaders, signature).select("leader", "item")

    leader_lines = frequent.join(leaders.select(F.col("leader").alias("item")), "item")
    within = leaders.select(
        F.col("leader").alias("First"), F.col("leader").alias("Second"), F.col("support").alias("Baskets")
    )
    counts = _pair_counts_in_chunks(stored(leader_lines.select("basket", "item"), "leader_lines")).unionByName(within)
    reached = counts.where(F.col("Baskets") >= threshold)
    first = named.toDF("First", "a")
    second = named.toDF("Second", "b")
    return (
        reached.join(first, "First")
        .join(second, "Second")
        .where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("First"), F.greatest("a", "b").alias("Second"), "Baskets")
        .distinct()
    )
