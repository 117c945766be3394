"""Near duplicates among embeddings: a forest of random projection trees with spill, verified inside leaves.

1. Equal vectors form a class, which stands as one vector from here on; copies, however many, are never paired.
2. Each of ``TREES`` trees splits all classes recursively: a node with more than ``LEAF`` classes is cut at a random quantile of
   a random projection of the unit vectors, and those within ``SPILL`` of the cut go to both sides. Of several
   projections and quantiles the one with the smallest overlap is taken. Cuts are fitted on about ``SAMPLE`` classes of the node, chosen by
   hash, several levels at once and for all nodes of all trees in the same jobs; every class is then routed. Nodes
   that are still too large are cut again, on a new sample, until none is.
3. A node that no projection can split (its vectors lie too close together) becomes a leaf of any size: it is dealt into
   chunks of about ``LEAF`` classes, and every two chunks meet in one task, so nothing is capped.
4. Inside a leaf all pairs are compared by one matrix product; pairs whose cosine lies within its rounding error of the threshold are
   computed again in double precision. A pair that shares several leaves counts in the first one only: every
   class knows its leaves. A leaf returns sums of links and the smallest member of each of its components, no pairs.
5. Links are summed, components are united over leaves.

Two vectors are missed only if every tree separates them. For cosine 0.95 in 64 dimensions that is a chance of about 2% a cut;
copies and nearer pairs are safer. The forest's recall against brute force is measured in the tests.

Results for special rows: vectors that are null, empty, zero or hold a null or non-finite component, and rows without
vec_id, link with nothing. Vectors of different length are not compared. Every row is a vector of its own: rows that share
a vec_id count as several links of others, and belong to one component. component_id of a row without vec_id is null, kept is true.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tillstar.llm.components import components
from tillstar.operators.skew import join_repeated
from tillstar.session import stored

TREES = 8
LEAF = 1024  # classes of a leaf that are compared in one task, on average if it cannot be split
SPILL = 0.02  # distance from a cut, on unit vectors, within which a vector goes to both sides
SAMPLE = 4096  # classes of a node that its cuts are fitted on, on average
LEVELS = 6  # fitted at once
POOL, TRIED = 32, 8  # projections of a node's levels, and how many are tried for a cut
LARGEST = 0.9  # share of a node that a side may keep
_SEED = 20240307
_ROUNDING = 1e-5  # more than single precision can be off for unit vectors

KEY = ("dim", "path")


def marked(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and, for vectors that take part, the two hashes that name their class."""
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding")
    )
    # a null or NaN component fails the first test, an infinite one the second
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    fit = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    return rows.select(
        "vec_id", F.when(fit, F.col("embedding")).alias("embedding"),
        F.when(fit, F.xxhash64("embedding")).alias("h1"), F.when(fit, F.xxhash64(F.lit(_SEED), "embedding")).alias("h2"),
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows or vanishes."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _draw(path: int, dim: int) -> np.random.Generator:
    return np.random.default_rng([_SEED, dim, path & (2**64 - 1)])


def _projections(path: int, dim: int) -> np.ndarray:
    """The pool of random directions of a node, the same wherever it is needed."""
    found = _draw(path, dim).standard_normal((dim, POOL))
    return found / np.linalg.norm(found, axis=0)


def _child(path: int, place: int) -> int:
    """The path of a node below ``path``: a 64-bit hash."""
    x = (path ^ (place * 0x9E3779B97F4A7C15)) & (2**64 - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & (2**64 - 1)
    x ^= x >> 31
    return x - 2**64 if x >> 63 else x


def fit_cuts(vectors: np.ndarray, path: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection (-1 at leaves) and cut of every place of a binary tree of ``LEVELS`` levels, fitted on a sample of ``rows`` rows."""
    dim = vectors.shape[1]
    along = _unit(vectors) @ _projections(path, dim)
    draw = _draw(_child(path, 0), dim)
    which, cuts = np.full(2**LEVELS, -1, np.int32), np.zeros(2**LEVELS)
    weight = rows / max(1, len(vectors))
    parts = {1: np.arange(len(vectors))}
    for place in range(1, 2**LEVELS):
        part = parts.pop(place, None)
        if part is None or len(part) * weight <= LEAF or len(part) < 16:
            continue
        best = None
        for p in draw.choice(POOL, TRIED, replace=False):
            values = along[part, p]
            for cut in np.quantile(values, draw.uniform(0.3, 0.7, 5)):
                low, high = int((values <= cut + SPILL).sum()), int((values >= cut - SPILL).sum())
                if max(low, high) <= LARGEST * len(part) and (best is None or low + high < best[0]):
                    best = (low + high, p, cut)
        if best is not None:
            which[place], cuts[place] = best[1:]
            values = along[part, best[1]]
            parts[2 * place], parts[2 * place + 1] = part[values <= best[2] + SPILL], part[values >= best[2] - SPILL]
    return which, cuts


def route(vectors: np.ndarray, path: int, which: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of rows and paths of the leaves that they reach; a row reaches several ones by spill."""
    along = _unit(vectors) @ _projections(path, vectors.shape[1])
    row, place, ended = np.arange(len(vectors)), np.ones(len(vectors), int), []
    while len(row):
        inner = (place < len(which)) & (which[np.minimum(place, len(which) - 1)] >= 0)
        ended.append((row[~inner], place[~inner]))
        row, place = row[inner], place[inner]
        value = along[row, which[place]]
        left, right = value <= cuts[place] + SPILL, value >= cuts[place] - SPILL
        row, place = np.concatenate([row[left], row[right]]), np.concatenate([2 * place[left], 2 * place[right] + 1])
    row, place = (np.concatenate(v) for v in zip(*ended))
    each, back = np.unique(place, return_inverse=True)
    return row, np.array([_child(path, int(p)) for p in each], np.int64)[back]


def _fitted(sample: DataFrame) -> DataFrame:
    """(dim, path, rows, which, cuts) of the nodes of a sample (dim, path, rows, embedding) that can be split."""

    def fit(part: pa.Table) -> pa.Table:
        dim, path, rows = (part.column(c)[0].as_py() for c in ("dim", "path", "rows"))
        which, cuts = fit_cuts(_matrix(part.column("embedding"), dim), path, rows)
        found = [{"dim": dim, "path": path, "rows": rows, "which": which, "cuts": cuts}] if which[1] >= 0 else []
        kinds = [("dim", pa.int32()), ("path", pa.int64()), ("rows", pa.int64()), ("which", pa.list_(pa.int32())), ("cuts", pa.list_(pa.float64()))]
        return pa.Table.from_pylist(found, schema=pa.schema(kinds))

    return sample.groupBy(*KEY).applyInArrow(fit, "dim int, path bigint, rows bigint, which array<int>, cuts array<double>")


def _routed(rows: DataFrame, kind: str) -> DataFrame:
    """(dim, path, node, tag, embedding) of rows with the cuts of their node, once for each leaf that they reach."""

    def work(batches):
        for batch in batches:
            dims, paths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            nodes, first, back = np.unique(np.stack([dims, paths], axis=1), axis=0, return_index=True, return_inverse=True)
            order = np.argsort(back.ravel(), kind="stable")
            ends = np.searchsorted(back.ravel()[order], np.arange(len(nodes) + 1))
            for k, (dim, path) in enumerate(nodes.tolist()):
                part = batch.take(pa.array(order[ends[k] : ends[k + 1]]))
                which, cuts = (np.array(part.column(c)[0].as_py()) for c in (5, 6))
                row, reached = route(_matrix(part.column(4), dim), path, which, cuts)
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(reached), *(part.column(c) for c in (2, 3, 4))], names=["dim", "path", "node", "tag", "embedding"])

    wide = rows.select("dim", "path", "node", "tag", "embedding", "which", "cuts")
    return wide.mapInArrow(work, f"dim int, path bigint, node bigint, tag bigint, embedding {kind}")


def leaves(classes: DataFrame, trees: int = TREES) -> DataFrame:
    """(dim, path, node, tag): the leaves of every tree, with the classes in them."""
    kind = classes.schema["embedding"].dataType.simpleString()
    roots = F.explode(F.array(*[F.lit(_child(t, 1)) for t in range(1, trees + 1)]))
    pending = classes.select("dim", roots.alias("path"), "node", "tag", "embedding")
    ended = []
    while True:
        large = stored(pending.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > LEAF), "large")
        if large.isEmpty():
            ended.append(pending.select(*KEY, "node", "tag"))
            break
        chosen = F.pmod(F.xxhash64("tag", "path"), F.lit(2**40)) < F.lit(float(SAMPLE * 2**40)) / F.col("rows")
        sample = join_repeated(pending.select(*KEY, "tag", "embedding"), large, list(KEY), "rows").where(chosen)
        cuts = stored(_fitted(sample.select(*KEY, "rows", "embedding")), "cuts")
        rest = pending.select(*KEY, "node", "tag").join(cuts.select(*KEY), list(KEY), "left_anti")
        ended.append(stored(rest, "leaves"))
        pending = stored(_routed(join_repeated(pending, cuts, list(KEY), "rows"), kind), "routed")
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    return found


def _counted_here(own: list[np.ndarray], here: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs share no leaf whose path is smaller than ``here``."""
    earlier = [paths[paths < here] for paths in own]
    codes, place = np.unique(np.concatenate(earlier), return_inverse=True) if earlier else (np.empty(0), np.empty(0, int))
    if not len(codes):
        return np.ones(len(i), bool)
    width = max(map(len, earlier))
    grid = np.full((len(own), width), -1)
    row = np.repeat(np.arange(len(own)), [len(p) for p in earlier])
    grid[row, np.concatenate([np.arange(len(p)) for p in earlier])] = place.ravel()
    several = np.flatnonzero(np.bincount(place.ravel()) > 1)
    if len(i) * width**2 > 8 * len(own) ** 2 * len(several):  # many pairs: one product over the leaves that several rows share
        held = np.zeros((len(own), len(codes)), np.float32)
        held[row, place.ravel()] = 1
        held = held[:, several]
        return (held @ held.T)[i, j] == 0
    shared = np.zeros(len(i), bool)
    for low in range(0, len(i), 1 << 16):
        a, b = grid[i[low : low + (1 << 16)]], grid[j[low : low + (1 << 16)]]
        shared[low : low + (1 << 16)] = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2))
    return ~shared


def _smallest_reached(n: int, i: np.ndarray, j: np.ndarray, node: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest node that it reaches by pairs."""
    label = node.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            return label


def compare_leaf(rows: pa.Table, threshold: float) -> pa.Table:
    """node, tag, number of links and smallest node reached, of the rows of a leaf (or of two chunks of one) that have links."""
    dim, here = rows.column("dim")[0].as_py(), rows.column("path")[0].as_py()
    node, tag, copies, chunk = (rows.column(c).to_numpy() for c in ("node", "tag", "copies", "chunk"))
    unit = _unit(_matrix(rows.column("embedding"), dim))
    single = unit.astype(np.float32)
    across = rows.column("low")[0] != rows.column("high")[0]
    found = []
    for low in range(0, len(node), 1024):
        about = single[low : low + 1024] @ single.T
        i, j = np.nonzero(about >= threshold - _ROUNDING)
        sure = about[i, j] >= threshold + _ROUNDING
        i += low
        apart = (i < j) & (chunk[i] != chunk[j]) if across else i < j
        i, j, sure = i[apart], j[apart], sure[apart]
        unsure = np.flatnonzero(~sure)
        sure[unsure] = np.einsum("nd,nd->n", unit[i[unsure]], unit[j[unsure]]) >= threshold
        found.append((i[sure], j[sure]))
    i, j = (np.concatenate(v) for v in zip(*found))
    links = np.zeros(len(node), np.int64)
    if len(i):
        offsets, flat = rows.column("paths").combine_chunks().offsets.to_numpy(), rows.column("paths").combine_chunks().flatten().to_numpy()
        begin = offsets[0]
        own = [flat[a - begin : b - begin] for a, b in zip(offsets[:-1], offsets[1:])]
        new = _counted_here(own, here, i, j)
        np.add.at(links, i[new], copies[j[new]])
        np.add.at(links, j[new], copies[i[new]])
    label = _smallest_reached(len(node), i, j, node)
    kept = pa.array(np.flatnonzero((links > 0) | (label < node)))
    return pa.table({"node": pa.array(node), "tag": pa.array(tag), "links": pa.array(links), "label": pa.array(label)}).take(kept)


def links_in_leaves(placed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(node, tag, links, label) of every leaf; a class's links are the sum over its leaves."""
    sizes = placed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    chunked = join_repeated(placed, stored(sizes, "leaf_sizes"), list(KEY), "rows").withColumn("chunks", F.ceil(F.col("rows") / LEAF))
    own = chunked.groupBy("node", "tag").agg(F.sort_array(F.collect_list(F.struct("path", "chunks"))).alias("own"))
    spread = own.join(classes, ["node", "tag"]).withColumn("leaf", F.explode("own")).select(
        "dim", "leaf.path", "node", "tag", "copies", "embedding", F.col("own.path").alias("paths"), _chunk("leaf.chunks").alias("chunk"), "leaf.chunks"
    )
    dealt = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))).select(
        "*", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    )
    return dealt.groupBy(*KEY, "low", "high").applyInArrow(lambda rows: compare_leaf(rows, threshold), "node bigint, tag bigint, links bigint, label bigint")


def _chunk(chunks: str) -> Column:
    return F.pmod(F.xxhash64("tag", F.lit(_SEED)), F.col(chunks))


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, trees: int = TREES) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors`` (vec_id, embedding)."""
    rows = stored(marked(vectors), "vectors")
    fit = rows.where("h1 is not null")
    classes = stored(
        fit.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding")).withColumn("tag", F.col("h1")), "classes",
    )
    placed = stored(leaves(classes, trees), "forest")
    found = stored(links_in_leaves(placed, classes.select("node", "tag", "dim", "copies", "embedding"), threshold), "links")
    degrees = found.groupBy("node", "tag").agg(F.sum("links").alias("links"))
    # rows that share a vec_id but not their vector join the components of their classes
    named = join_repeated(fit.select("vec_id", "h1", "h2"), classes.select("h1", "h2", "node", "tag", "copies"), ["h1", "h2"], "copies")
    several = named.groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("vec_id", "a")
    same = named.join(several, "vec_id").select("a", F.col("node").alias("b"))
    labels = components(found.where("label < node").select(F.col("label").alias("a"), F.col("node").alias("b")).union(same))
    known = stored(
        classes.select("h1", "h2", "node", "tag", "copies").join(degrees, ["node", "tag"], "left").join(labels, "node", "left").select(
            "h1", "h2", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "node").alias("component_id")
        ), "known",
    )
    linked = join_repeated(fit.select("vec_id", "h1", "h2"), known, ["h1", "h2"], "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where("h1 is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
