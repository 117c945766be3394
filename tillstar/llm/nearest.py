"""Nearest neighbours by inner product: a block matrix join over int8 tiles with error bounds.

Query and candidate vectors are dealt into blocks by hash; every pair of blocks is one cell of a grid and is joined by
its key, so that a task holds one query block and one candidate block, whatever the number of rows. In a cell all
vectors are rounded to int8 with a scale of their own. The product of two int8 tiles is exact (whole numbers in
float32 stay below 2**24 for stripes of 1024 dimensions), and with q = q' + e, c = c' + f

    |<q, c> - <q', c'>| <= |e| |c| + |q'| |f|

bounds what the rounding can change. A pair whose upper bound lies below the k-th best lower bound of its query cannot
be among the k nearest. Survivors are recomputed in double precision, in order of the dimensions, and merged by heaps:
per query inside a cell, and over cells by a limited window. The result is exact; nothing is sampled or capped.

Results for special rows: vectors that are null, empty, zero or hold a null or non-finite component, and rows
without vec_id, take no part. Vectors of different length are not compared. Rows that share a vec_id count once,
with their smallest vector, and never as neighbours of each other. Equal scores are ordered by vec_id.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import stored

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
TILE = 2048  # candidates multiplied at once
STRIPE = 1024  # dimensions multiplied at once

FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) and dim of the rows that take part, one per vec_id."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    # a null or NaN component fails the first test, an infinite one the second
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    rows = rows.where("vec_id is not null and embedding is not null").where(finite & F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))


class Tiles:
    """A block of vectors: originals, int8 values, scales, and the norms that bound the rounding."""

    def __init__(self, rows: pa.Table, dim: int):
        self.ids = rows.column("vec_id").to_numpy()
        flat = rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = self.full = flat.reshape(-1, dim)
        self.scale = np.abs(x).max(axis=1) / 127
        self.scale[self.scale == 0] = np.finfo(float).tiny  # subnormal vectors
        self.small = np.clip(np.rint(x / self.scale[:, None]), -127, 127).astype(np.int8)
        back = self.small * self.scale[:, None]
        self.rounded, self.error, self.norm = (np.linalg.norm(v, axis=1) for v in (back, x - back, x))


def products(queries: Tiles, rows: Tiles, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Approximate inner products with candidates low..high, and the most by which they can be off."""
    whole = np.zeros((len(queries.ids), high - low))
    for d in range(0, queries.small.shape[1], STRIPE):
        whole += queries.small[:, d : d + STRIPE].astype(np.float32) @ rows.small[low:high, d : d + STRIPE].astype(np.float32).T
    whole *= queries.scale[:, None]
    whole *= rows.scale[low:high]
    off = queries.error[:, None] * rows.norm[low:high] + queries.rounded[:, None] * rows.error[low:high]
    off += 1e-12 * queries.norm[:, None] * rows.norm[low:high]  # rounding of the doubles themselves
    return whole, off


def exact(queries: Tiles, rows: Tiles, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed from the first dimension to the last."""
    total = np.zeros(len(i))
    left, right = queries.full.T, rows.full.T
    for d in range(len(left)):
        total += left[d][i] * right[d][j]
    return total


def best_in_cell(queries: Tiles, rows: Tiles, k: int) -> tuple[list[int], list[int], list[float]]:
    """The k best candidates of each query of a cell."""
    n = len(queries.ids)
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(n)]  # (score, -vec_id), the worst first
    floor = np.full(n, -np.inf)  # no score below can be among the k best
    for low in range(0, len(rows.ids), TILE):
        high = min(low + TILE, len(rows.ids))
        about, off = products(queries, rows, low, high)
        own = queries.ids[:, None] == rows.ids[low:high]
        about[own], off[own] = -np.inf, 0
        if high - low >= k:
            floor = np.maximum(floor, np.partition(about - off, high - low - k, axis=1)[:, high - low - k])
        i, j = np.nonzero((about + off >= floor[:, None]) & ~own)
        scores = exact(queries, rows, i, j + low)
        for q, key, score in zip(i.tolist(), rows.ids[j + low].tolist(), scores.tolist()):
            heap = heaps[q]
            if len(heap) < k:
                heapq.heappush(heap, (score, -key))
            elif (score, -key) > heap[0]:
                heapq.heapreplace(heap, (score, -key))
        full = [q for q, heap in enumerate(heaps) if len(heap) == k]
        floor[full] = np.maximum(floor[full], [heaps[q][0][0] for q in full])
    out = [(key, -item, score) for key, heap in zip(queries.ids.tolist(), heaps) for score, item in heap]
    return tuple(map(list, zip(*out))) if out else ([], [], [])


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest rows of each row that ``is_query`` selects."""
    rows = stored(usable(vectors), "vectors")
    query_rows = rows.where(is_query)
    n, m = rows.count(), query_rows.count()
    down, across = max(1, -(-m // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_BLOCK))
    dealt = F.xxhash64("vec_id")
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    left = query_rows.select(
        "vec_id", "embedding", "dim", F.pmod(dealt, F.lit(down)).alias("row"), each(across).alias("column")
    )
    right = rows.select(
        "vec_id", "embedding", "dim", each(down).alias("row"), F.pmod(dealt, F.lit(across)).alias("column"),
    )

    def cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = ([], [], [])
        if len(queries) and len(candidates):
            dim = queries.column("dim")[0].as_py()
            found = best_in_cell(Tiles(queries, dim), Tiles(candidates, dim), k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    keys = ("dim", "row", "column")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
