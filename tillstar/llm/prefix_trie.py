"""The trie of conversation prefixes, built by van Emde Boas recursion.

Conversations are sequences of turns; a node of depth d is a distinct sequence of first d turns. A trie of height 2^(k+1)
is cut at half its height: the upper trie holds the first 2^k turns, a forest of lower tries hangs on the cut prefixes. All
tries of one height are treated in the same jobs, whatever conversations they belong to:

1. Digests of segments of 2^k turns are combined from those of half the length (rows halve from step to step).
2. Cutting downwards from the whole height, each prefix that ends at a cut is named by the name of the prefix where its
   trie begins and the digest of the upper segment. After the last step every prefix has a name (rows double).
3. Prefixes with equal names are one node; its members' smallest conv_id names it from there on. The nodes that a
   conversation is the smallest member of form a chain that reaches from some depth to its end.
4. Totals are grafted upwards: sums over segments of 2^k nodes of a chain are combined upwards, then handed down the same
   cuts, the total of a lower part being added to the upper part above it. That gives each node the total of its own
   chain below it; the totals of all other chains are added where they hang, at every node that their conversation passes.

Every step is a join or a sum by (conversation, segment), so no step holds a conversation or the members of a node in one
task: steps 1, 2 and 4 take twice the logarithm of the longest conversation in jobs and a multiple of the number of
turns in rows. Positions of turns are counted over range-sorted rows, so a conversation with most of all turns is spread, too. Only the
digest of the members that end at a node is a chain by definition: their sorted ids stream through one task, in batches.

Names and turns are compared by 128-bit hashes.

Results for special rows: null roles and texts are empty; turns are ordered by turn (nulls first), then role, then text,
and equal rows are turns of their own. Rows without conv_id belong to no conversation and are left out. Without any
conversation there is no node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.skew import join_repeated
from tillstar.session import stored

GROUP, HEADS = 5, 9  # conversations that may share a beginning, and numbers of turns that they may share
_SALT = 88172645463325252

ENDS = "rep bigint, d bigint, ends_sha256 string"


def _digest(*parts: str | Column) -> tuple[Column, Column]:
    return F.xxhash64(*parts).alias("x"), F.xxhash64(F.lit(_SALT), *parts).alias("y")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos from 1, x, y, size): digest of role and text and bytes of the text of every turn.

    Rows are sorted by range, so that a long conversation is spread over tasks, and numbered within task and
    conversation; a window over one row per task and conversation gives where a task's rows begin.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    distinct = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    sorted_rows = stored(
        distinct.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).withColumn("task", F.spark_partition_id()), "sorted_turns"
    )
    order = Window.partitionBy("conv", "task").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    local = sorted_rows.withColumn("before", F.coalesce(F.sum("copies").over(order), F.lit(0)))
    earlier = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sorted_rows.groupBy("conv", "task").agg(F.sum("copies").alias("here")).withColumn("start", F.coalesce(F.sum("here").over(earlier), F.lit(0)))
    placed = local.join(starts.select("conv", "task", "start"), ["conv", "task"])
    first = F.col("start") + F.col("before") + 1
    return placed.select(
        "conv", F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("pos"), *_digest("role", "text"), F.octet_length("text").cast("bigint").alias("size")
    )


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, length) and their turns (conv, pos, x, y, size), beginnings shared within groups of ``GROUP``.

    The first h turns are those of the conversation that begins the group, h being a checksum of the id modulo ``HEADS``.
    """
    lengths = stored(own.groupBy("conv").agg(F.max("pos").alias("own")), "lengths")
    known = lengths.select(
        "conv", "own", (F.col("conv") - F.col("conv") % GROUP).alias("base"), (F.crc32(F.col("conv").cast("string")) % HEADS).alias("h")
    )
    bases = lengths.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    heads = known.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_own", F.lit(0))))
    plan = stored(heads.select("conv", "own", "base", "h", "head", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "plan")
    first = own.where(F.col("pos") < HEADS).withColumnRenamed("conv", "base")  # fewer than HEADS rows a conversation
    taken = first.join(plan.where("head > 0").select("conv", "base", "head"), "base").where("pos <= head").select("conv", "pos", "x", "y", "size")
    rest = join_repeated(own, plan.select("conv", "own", "h", "head"), ["conv"], "own").where("pos > h")
    moved = rest.select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "x", "y", "size")
    return plan.select("conv", "length"), taken.unionByName(moved)


def _height(lengths: DataFrame) -> int:
    """The least k with 2^k above every length."""
    return int(lengths.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]).bit_length()


def segments(sequence: DataFrame, height: int) -> list[DataFrame]:
    """For each k the digests (conv, seg, x, y) of whole segments of 2^k turns and the bytes of their last turn."""
    levels = [stored(sequence.select("conv", (F.col("pos") - 1).alias("seg"), "x", "y", "size"), "segments")]
    side = lambda c, of: F.max(F.when(F.col("seg") % 2 == of, F.col(c)))
    for _ in range(1, height):
        halves = levels[-1].groupBy("conv", F.expr("seg div 2").alias("whole")).agg(
            *[side(c, of).alias(f"{c}{of}") for c in ("x", "y") for of in (0, 1)], side("size", 1).alias("size"), F.count(F.lit(1)).alias("n")
        )
        whole = halves.where("n = 2").select("conv", F.col("whole").alias("seg"), *_digest("x0", "y0", "x1", "y1"), "size")
        levels.append(stored(whole, "segments"))
    return levels


def named_prefixes(lengths: DataFrame, sequence: DataFrame) -> tuple[DataFrame, int]:
    """(conv, d, x, y, length, size): the name of every prefix of every conversation, and the height of the trie."""
    height = _height(lengths)
    levels = segments(sequence, height)
    zero = F.lit(0).cast("bigint")
    names = lengths.select("conv", zero.alias("d"), zero.alias("x"), zero.alias("y"), "length", zero.alias("size"))
    for k in reversed(range(height)):
        upper = levels[k].where("seg % 2 = 0").select("conv", (F.col("seg") * 2**k).alias("d"), F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("size").alias("last"))
        cut = names.join(upper, ["conv", "d"]).select("conv", (F.col("d") + 2**k).alias("d"), *_digest("x", "y", "sx", "sy"), "length", F.col("last").alias("size"))
        names = stored(names.union(cut), "names")
    return names, height


def chain_totals(values: DataFrame, height: int, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Sums of ``columns`` from each (conv, d) to the end of its chain, and over each whole chain."""
    sums = [values.select("conv", F.col("d").alias("seg"), *columns)]
    for _ in range(height):
        sums.append(stored(sums[-1].groupBy("conv", F.expr("seg div 2").alias("seg")).agg(*[F.sum(c).alias(c) for c in columns]), "sums"))
    below = sums[height]
    for k in reversed(range(height)):
        # the lower half has the total of the whole without the upper half; the upper one has all of it
        upper = sums[k].where("seg % 2 = 0").select("conv", (F.col("seg") + 1).alias("seg"), *[F.col(c).alias(f"upper_{c}") for c in columns])
        halves = sums[k].select("conv", "seg", F.expr("seg div 2").alias("whole")).join(upper, ["conv", "seg"], "left")
        whole = below.withColumnRenamed("seg", "whole")
        below = stored(
            halves.join(whole, ["conv", "whole"]).select("conv", "seg", *[(F.col(c) - F.coalesce(f"upper_{c}", F.lit(0))).alias(c) for c in columns]), "below"
        )
    return below.withColumnRenamed("seg", "d"), sums[height].select("conv", *columns)


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending ids of the conversations that end at each node, as a stream of sorted rows."""

    def work(batches):
        at, digest = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for rep, d, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (rep, d) != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (rep, d), hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield _ends(done)
        yield _ends([(*at, digest.hexdigest())] if at is not None else [])

    by_node = ends.select("rep", "d", "conv").repartition("rep", "d").sortWithinPartitions("rep", "d", "conv")
    return by_node.mapInArrow(work, ENDS)


def _ends(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["rep", "d", "ends_sha256"])


def trie(lengths: DataFrame, sequence: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences: ``lengths`` (conv, length) and ``sequence`` (conv, pos, x, y, size)."""
    names, height = named_prefixes(lengths, sequence)
    key = ["d", "x", "y"]
    nodes = stored(names.groupBy(*key).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("deepest"), F.max("size").alias("size")
    ), "nodes")
    members = stored(join_repeated(names.select("conv", "length", *key), nodes.select(*key, "rep", "n_convs"), key, "n_convs").select("conv", "d", "length", "rep"), "members")
    totals = ["n_leaves", "saved_tokens"]
    values = nodes.select(
        F.col("rep").alias("conv"), "d", (F.col("deepest") == F.col("d")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    own, whole = chain_totals(values, height, totals)
    tops = nodes.groupBy(F.col("rep").alias("conv")).agg(F.min("d").alias("top"))  # above it a conversation is not the smallest member
    hanging = stored(whole.join(tops, "conv"), "chains")
    grafts = join_repeated(members.where("rep <> conv").select("conv", "d", "rep"), hanging, ["conv"], "top").groupBy("rep", "d").agg(
        *[F.sum(c).alias(f"grafted_{c}") for c in totals]
    )
    parents = members.select(F.col("conv").alias("rep"), (F.col("d") + 1).alias("d"), F.col("rep").alias("parent"))
    linked = stored(nodes.select("rep", "d", "n_convs").join(parents, ["rep", "d"], "left"), "linked")
    children = linked.where("d > 0").groupBy(F.col("parent").alias("rep"), (F.col("d") - 1).alias("d")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = end_digests(members.where("d = length"))
    full = linked.join(own.withColumnRenamed("conv", "rep"), ["rep", "d"])
    for more in (grafts, children, ends):
        full = full.join(more, ["rep", "d"], "left")
    return full.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        *[(F.col(c) + F.coalesce(f"grafted_{c}", F.lit(0))).alias(c) for c in totals],
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations: a row per node."""
    own = stored(turns(conversations), "turns")
    return trie(*rebuilt(own))
