"""Connected components of links between documents, and their smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each linked node reaches.

    ``links`` has bigint columns a and b. Labels spread to neighbours and then jump to the label of their
    label, so that distances at least halve; every round is stored. Only minima are shuffled, which combine
    before the shuffle: a node with very many links costs no task more than others.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    edges = stored(both, "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        moved = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        roots = moved.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = stored(moved.join(roots, "label").select("node", "was", F.col("root").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("was <> label").isEmpty():
            return labels
