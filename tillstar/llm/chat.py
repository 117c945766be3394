"""Chat formatting: root-to-leaf paths of reply trees, ranked by score, each formatted as one conversation.

Messages are nodes (tree, node, parent, role, text, score); a node whose parent is null or absent is a root. Paths are
enumerated by self-joins whose number grows with the logarithm of the depth: a table of 2^i-th ancestors is joined
with itself to give the 2^(i+1)-th ones, and each leaf is then joined with these tables from the largest down, which
meets every ancestor once (its distance in binary). A branch scores the mean of its nodes' scores; branches of a tree
are ranked by score, ties by leaf.

Template: every message is written as ``### role: text</turn>`` and a line feed. In texts and roles ``\\`` becomes
``\\\\``, ``</turn>`` becomes ``<\\/turn>`` and the space that ends ``### `` becomes ``\\ ``; a role
also has its ``: `` written ``:\\ ``. So neither ``### `` nor ``</turn>`` occurs in an escaped text, every backslash escapes the
character behind it, and reading back is exact. The loss mask is a list of code point ranges of the output, one for the
text of each assistant message.

Results for special rows: null texts, roles and scores count as empty or 0; an empty text is a message. Messages that
only reach a cycle of parents belong to no path. Conversations: rows are ordered by turn, then role and text, nulls first;
repeated turns are messages of their own; rows without conv_id form one conversation with a null id.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import small_batches
from tillstar.session import stored

OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
TRAINED = "assistant"

FORMATTED = "tree bigint, leaf bigint, place int, formatted string, loss array<struct<begin: bigint, end: bigint>>"
DIGESTS = "conv_id bigint, place int, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>").replace("### ", "###\\ ")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def write(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the ranges under the loss mask."""
    parts, masks, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role).replace(BETWEEN, ":\\ ") + BETWEEN, escape(text)
        if role == TRAINED:
            masks.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), masks


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part[len(OPEN) :].partition(BETWEEN)
        turns.append((unescape(role), unescape(text)))
    return turns


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every node on the path from each leaf to its root, ``up`` steps above the leaf."""
    nodes = messages.select("tree", "node", "parent")
    same = lambda a, b, key: F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.{key}") == F.col(f"{b}.node"))
    step = stored(
        nodes.alias("c").join(nodes.alias("p"), same("c", "p", "parent")).select("c.tree", "c.node", F.col("p.node").alias("above")), "step"
    )
    limit = nodes.count()
    jumps, reach = [step], 1
    while reach <= limit and not jumps[-1].isEmpty():
        jumps.append(stored(
            jumps[-1].alias("c").join(jumps[-1].alias("p"), same("c", "p", "above")).select("c.tree", "c.node", "p.above"), "jump"
        ))
        reach *= 2
    parents = step.select("tree", F.col("above").alias("node")).distinct()
    leaves = nodes.alias("c").join(parents.alias("p"), same("c", "p", "node"), "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up"))
    if not jumps[-1].isEmpty():  # nodes that still have an ancestor after more steps than there are nodes hang on a cycle
        found = found.alias("c").join(jumps[-1].alias("p"), same("c", "p", "node"), "left_anti")
        jumps.append(jumps[-1].limit(0))
    for i in reversed(range(len(jumps) - 1)):
        higher = found.alias("c").join(jumps[i].alias("p"), same("c", "p", "node")).select("c.tree", "c.leaf", F.col("p.above").alias("node"), F.col("up") + 2**i)
        found = stored(found.union(higher), "paths")
    return found


def ranked_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """``paths`` with the ``place`` of their branch in its tree, of the ``branches`` best ones; only keys and scores are shuffled."""
    steps = paths(messages)
    on = F.col("c.tree").eqNullSafe(F.col("p.tree")) & (F.col("c.node") == F.col("p.node"))
    scored = steps.alias("c").join(messages.alias("p"), on).select("c.tree", "c.leaf", F.coalesce(F.col("p.score").cast("double"), F.lit(0.0)).alias("score"))
    means = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("mean"))
    order = Window.partitionBy("tree").orderBy(F.col("mean").desc(), "leaf")
    best = means.withColumn("place", F.row_number().over(order)).select("tree", "leaf", "place")
    if branches is not None:
        best = best.where(F.col("place") <= branches)
    same = F.col("c.tree").eqNullSafe(F.col("b.tree")) & (F.col("c.leaf") == F.col("b.leaf"))
    return steps.alias("c").join(best.alias("b"), same).select("c.*", "b.place")


def format_branches(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, place (rank of the branch), formatted and loss of the ``branches`` best paths of each tree (all, if None)."""
    small_batches(messages.sparkSession)
    chosen = stored(ranked_paths(messages, branches), "chosen")
    # texts are joined to chosen paths only
    placed = chosen.alias("c").join(
        messages.alias("p"), F.col("c.tree").eqNullSafe(F.col("p.tree")) & (F.col("c.node") == F.col("p.node"))
    ).select("c.tree", "c.leaf", "c.place", "c.up", F.coalesce("p.role", F.lit("")).alias("role"), F.coalesce("p.text", F.lit("")).alias("text"))
    # a path is one output row, so its messages have to meet
    whole = placed.groupBy("tree", "leaf", "place").agg(F.sort_array(F.collect_list(F.struct("up", "role", "text")), asc=False).alias("turns"))

    def work(batches):
        for batch in batches:
            done = [write([(t["role"], t["text"]) for t in turns.as_py()]) for turns in batch.column(3)]
            masks = pa.array([[{"begin": a, "end": b} for a, b in m] for _, m in done], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([t for t, _ in done], pa.string()), masks], names=["tree", "leaf", "place", "formatted", "loss"])

    return whole.mapInArrow(work, FORMATTED)


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as trees without branches: every turn replies to the one before."""
    order = Window.partitionBy("tree").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("tree"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    numbered = rows.withColumn("node", F.row_number().over(order).cast("bigint"))
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and trained text, read from the formatted conversations and their masks."""

    def work(batches):
        for batch in batches:
            rows = []
            for text, masks in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                turns = read(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(unescape(text[m["begin"] : m["end"]]) for m in masks)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            cells = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *cells], names=["conv_id", "place", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(F.col("tree").alias("conv_id"), "leaf", "place", "formatted", "loss").mapInArrow(work, DIGESTS)
