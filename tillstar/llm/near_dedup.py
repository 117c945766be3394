"""Near duplicates: MinHash bands propose pairs, sequential Bayesian tests prune them, full sets confirm.

A document's set is its distinct shingles of ``k`` words (A-Z lower-cased, words between white space); with fewer
words the whole sequence is the one shingle; without words it is empty and linked with nothing. Two documents are
linked when ``100 * |intersection| >= percent * |union|``, and components of links share their smallest doc_id.

1. Each text becomes a digest of its set and one 64-bit key per band. Equal sets form a class, which is
   represented by its smallest doc_id: copies, however many, are one node from here on.
2. Nodes that share a band key form a bucket. In every bucket each node is compared with the smallest one only.
3. A pair's signatures are compared batch by batch. With a uniform prior the similarity after m of n matches is
   Beta(m+1, n-m+1), so P(similarity >= t) = P(Binomial(n+1, t) <= m); a pair whose probability falls below
   ``miss`` leaves. Survivors are confirmed on their full sets.
4. What is left are buckets that hold several components, such as texts that share a long passage but are not linked.
   They are dealt into chunks, by number of nodes and by size of their sets, so that a task's memory is bounded whatever
   the length of texts; every two chunks of a bucket meet in one task, where pairs of different components are
   tested by step 3 and by their full sets and only links come out. No bucket is capped, and no pair becomes a row.

Classes that hold over a thousandth of all rows are joined by broadcast (fewer than a thousand keys), so their rows
are never shuffled by that key. Buckets are joined by band, and adaptive execution splits a hot one.

The number of bands is the least for which a pair at the threshold shares none with probability under ``miss``.
Shingles are compared by 64-bit hash.

Results for special rows: a null text has no words. Rows that share a doc_id are versions of one document: those
with words belong to one component. Rows without doc_id take part in no link: component_id is null, kept is true. One row is
returned for each row; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import BoundedCache, small_batches, text_or_empty
from tillstar.llm.components import components
from tillstar.operators.skew import join_repeated
from tillstar.session import stored

ROWS = 5  # hashes in a band
BATCH = 20  # hashes compared between two looks at the posterior
MISS = 1e-7
CHUNK = 2048  # nodes of a bucket that are compared in one task, on average
CHUNK_SHINGLES = 1 << 22  # shingles of these nodes, on average
_SLICE = 1024  # shingles hashed at once


def bands_for(percent: int, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** ROWS))


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Smallest m for which m matches of n leave P(similarity >= threshold) at ``miss`` or more."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _band_keys(signature: np.ndarray) -> np.ndarray:
    grid = signature.reshape(-1, ROWS).astype(np.uint64)
    out = np.arange(1, len(grid) + 1, dtype=np.uint64)
    for j in range(ROWS):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + grid[:, j])
    return out.view(np.int64)


def _looks(hashes: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """After how many hashes a pair is looked at, and the matches that it needs by then."""
    return [(n, least_matches(n, threshold, miss)) for n in [*range(BATCH, hashes, BATCH), hashes]]


class Shingler:
    """Sets, signatures and band keys of texts; one per worker process."""

    def __init__(self, k: int, bands: int):
        self.k, self.bands = k, bands
        draw = np.random.default_rng(20240229)
        self.factors = draw.integers(0, 2**63, bands * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.words = BoundedCache(xxhash.xxh3_64_intdigest)

    def shingles(self, text: str) -> np.ndarray:
        """Sorted 64-bit hashes of the distinct shingles."""
        words = text.encode().lower().split()  # of bytes: both know ASCII only
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(self.k, len(hashes))
        n = len(hashes) - width + 1
        out = np.full(n, width, np.uint64)
        for j in range(width):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n])
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for k in range(0, len(shingles), _SLICE):
            part = shingles[k : k + _SLICE]
            np.minimum(low, (self.factors[:, None] * part).min(axis=1), out=low)
        return (low >> np.uint64(32)).astype(np.uint32)


SKETCH = "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>"
SETS = "node bigint, n bigint, sig binary, members binary"


def sketches(docs: DataFrame, k: int, bands: int) -> DataFrame:
    """Size, digest and band keys of the set of each row; digest and keys are null for an empty set."""
    small_batches(docs.sparkSession)

    def work(batches):
        own = Shingler(k, bands)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = own.shingles(text.as_py())
                if len(found):
                    digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                    rows.append((len(found), int(digest[0]), int(digest[1]), _band_keys(own.signature(found))))
                else:
                    rows.append((0, None, None, None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            rest = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *rest], names=["doc_id", "n_shingles", "h1", "h2", "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(work, SKETCH)


def full_sets(docs: DataFrame, nodes: DataFrame, k: int, bands: int) -> DataFrame:
    """Signature and sorted shingle hashes of the documents in ``nodes``."""

    def work(batches):
        own = Shingler(k, bands)
        for batch in batches:
            found = [own.shingles(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in found], pa.int64()),
                    pa.array([own.signature(s).tobytes() for s in found], pa.binary()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                names=["node", "n", "sig", "members"],
            )

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("node"), text_or_empty().alias("text"))
    return wanted.join(nodes.select("node"), "node", "left_semi").mapInArrow(work, SETS).where("n > 0")


def plausible(pairs: DataFrame, sets: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) that neither the sizes nor any batch of their signatures rules out."""

    def work(batches):
        looks = None
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            if not left:
                continue
            x = np.frombuffer(b"".join(left), np.uint32).reshape(len(left), -1)
            y = np.frombuffer(b"".join(right), np.uint32).reshape(len(left), -1)
            if looks is None:
                looks = _looks(x.shape[1], threshold, miss)
            alive, matched, seen = np.arange(len(x)), np.zeros(len(x), int), 0
            for n, least in looks:
                matched = matched + (x[alive, seen:n] == y[alive, seen:n]).sum(axis=1)
                alive, matched, seen = alive[matched >= least], matched[matched >= least], n
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(alive)), batch.column(1).take(pa.array(alive))], names=["a", "b"])

    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    sized = pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-6)
    return sized.select("a", "b", "sa", "sb").mapInArrow(work, "a bigint, b bigint")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, joint): exact sizes of intersection and union."""

    def work(batches):
        for batch in batches:
            shared, joint = [], []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (left, right))
                common = len(np.intersect1d(x, y, assume_unique=True))
                shared.append(common)
                joint.append(len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(joint, pa.int64())], names=["a", "b", "shared", "joint"]
            )

    a = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    full = pairs.join(a, "a").join(b, "b").select("a", "b", "ma", "mb")
    found = full.mapInArrow(work, "a bigint, b bigint, shared bigint, joint bigint")
    # a node that has several versions is as near as its nearest one
    return found.groupBy("a", "b").agg(F.max_by(F.struct("shared", "joint"), F.col("shared") / F.col("joint")).alias("best")).select("a", "b", "best.*")


def _links(pairs: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """The linked ones among distinct pairs."""
    survivors = stored(plausible(pairs, sets, percent / 100, miss), "survivors")
    return compared(survivors, sets).where(F.col("shared") * 100 >= F.col("joint") * percent).select("a", "b")


def _links_in_cell(rows: pa.Table, percent: int, looks: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Links between different components of a cell, by full sets.

    A pair counts in the first band that it shares only, and not once links have joined both sides.
    """
    node, label, chunk, low = (rows.column(c).to_numpy() for c in ("node", "label", "chunk", "low"))
    band = rows.column("band")[0].as_py()
    sets = [np.frombuffer(v.as_py(), np.uint64) for v in rows.column("members")]
    sizes = np.array([len(v) for v in sets])
    sig = np.frombuffer(b"".join(v.as_py() for v in rows.column("sig")), np.uint32).reshape(len(node), -1)
    keys = np.vstack([_band_keys(v) for v in sig])
    label = label.copy()
    across = chunk.min() != chunk.max()
    out: tuple[list[int], list[int]] = ([], [])
    for x in range(len(node)):
        alive = label != label[x]
        if across:
            alive &= (chunk != chunk[x]) & (chunk[x] == low[x])
        else:
            alive[: x + 1] = False
        alive &= np.minimum(sizes, sizes[x]) * 100 >= percent * np.maximum(sizes, sizes[x])
        others = np.flatnonzero(alive)
        matched, seen = np.zeros(len(others), int), 0
        for n, least in looks:
            matched = matched + (sig[others, seen:n] == sig[x, seen:n]).sum(axis=1)
            others, matched, seen = others[matched >= least], matched[matched >= least], n
            if not len(others):
                break
        if len(others):
            first = (keys[others] == keys[x]).argmax(axis=1)
            others = others[keys[x][first] == band]
        for y in others.tolist():
            if label[y] == label[x]:
                continue
            common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if common * 100 >= percent * (sizes[x] + sizes[y] - common):
                out[0].append(int(min(node[x], node[y])))
                out[1].append(int(max(node[x], node[y])))
                label[label == label[y]] = label[x]
    return out


def _between_components(members: DataFrame, stars: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links between nodes of one bucket that the comparisons with its smallest node left in different components.

    Every mixed bucket is dealt into chunks of about ``CHUNK`` nodes and ``CHUNK_SHINGLES`` shingles at most; each pair of chunks is one cell, in which pairs
    are tested in numpy by their full sets and only links come out. At least one link comes out for each two components that are linked.
    """
    placed = members.join(components(stars), "node", "left").select("band", "node", "n", F.coalesce("label", "node").alias("label"))
    bands = placed.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("shingles"))
    chunks = F.greatest(F.ceil(F.col("nodes") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES))
    mixed = bands.where("low < high").select("band", chunks.alias("chunks"))
    dealt = (
        placed.select("band", "node", "label").join(mixed, "band")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .select("band", "node", "label", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    )
    looks = _looks(bands_for(percent, miss) * ROWS, percent / 100, miss)

    def cell(rows: pa.Table) -> pa.Table:
        a, b = _links_in_cell(rows, percent, looks)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    cells = dealt.join(sets.select("node", "sig", "members"), "node").groupBy("band", "low", "high")
    return stored(cells.applyInArrow(cell, "a bigint, b bigint").distinct(), "inner")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text)."""
    bands = bands_for(percent, miss)
    sketch = stored(sketches(docs, k, bands), "sketch")
    known = sketch.where("h1 is not null and doc_id is not null")
    classes = stored(known.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows")), "classes")
    leading = classes.select("h1", "h2", F.col("node").alias("doc_id"))
    first = known.join(leading, ["h1", "h2", "doc_id"]).dropDuplicates(["h1", "h2", "doc_id"])
    keyed = stored(first.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("band")), "bands")
    shared = keyed.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    members = stored(keyed.join(shared.select("band", "leader"), "band"), "members")
    sets = stored(full_sets(docs, members.select("node").distinct(), k, bands), "sets")
    pairs = members.where("leader < node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(_links(pairs, sets, percent, miss), "stars")
    links = stars.unionByName(_between_components(members.select("band", "node", "n"), stars, sets, percent, miss))

    versions = stored(join_repeated(known.select("doc_id", "n_shingles", "h1", "h2"), classes, ["h1", "h2"], "rows").select("doc_id", "n_shingles", "node"), "versions")
    several = versions.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    same = versions.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
    labels = components(links.union(same.where("a <> b")))
    alone = sketch.where("h1 is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    # nodes that no link reaches label themselves
    nodes = classes.groupBy("node").agg(F.sum("rows").alias("rows")).join(labels, "node", "left").select("node", "rows", F.coalesce("label", "node").alias("component_id"))
    named = alone.union(join_repeated(versions, stored(nodes, "nodes"), ["node"], "rows").select("doc_id", "n_shingles", "component_id"))
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
