"""Quality classifier by co-training: a text view and a metadata view label documents for each other.

The text view sees the words and pairs of neighbouring words of the whole text, hashed into buckets, shares of character
kinds, and how words and lines repeat; the metadata view sees language, source and length. Each view has a logistic regression (Newton steps, ridge penalty). From a bounded sample of labelled rows
and a bounded pool of unlabelled ones, both are trained; in every round each view labels the pool documents that it is
most sure of, and these join the training rows of the other view. A quarter of the labelled sample is held out: on it
each view is calibrated (a logistic curve over its score), and the calibrated views are combined by a third
regression. The cut is the one that costs least on the held-out rows, where a good document that goes costs as much
as ``COST_OF_GOOD`` bad ones that stay.

Fitting reads ``LABELLED`` labelled and ``POOL`` other documents at most (in hash order, so reruns agree; of rows that share
a doc_id the smallest by text); every document is scored.

Results for special rows: a null text is empty; unknown languages and sources share buckets by hash, null ones
have one of their own; a null n_chars counts as 0. A document is good if all its labels say so; labels without
quality or doc_id don't count. If the labels lack a class there is no model: scores are 1 and all is kept. Every row
is scored, also repeated ones and those without doc_id; other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import operator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import BoundedCache, small_batches, text_or_empty

LABELLED, POOL = 12_000, 4_000
ROUNDS, SURE, PER_ROUND = 4, 0.97, 400
COST_OF_GOOD = 10
BUCKETS = 32
WORD_BUCKETS = 96  # of words and pairs of words

SCORES = "doc_id bigint, text_score double, meta_score double, score double, kept boolean"

_KINDS = np.full(256, 0)  # of bytes: beyond ASCII, controls, letters, digits, blanks, each other mark
_KINDS[:128] = 1
for _low, _high, _kind in (("a", "z", 2), ("A", "Z", 3), ("0", "9", 4)):
    _KINDS[ord(_low) : ord(_high) + 1] = _kind
_KINDS[ord(" ")], _KINDS[ord("\n")] = 5, 6
_marks = [c for c in range(33, 127) if not chr(c).isalnum()]
_KINDS[_marks] = np.arange(7, 7 + len(_marks))
N_KINDS = 7 + len(_marks)


#: Hashes of words, kept per process.
_hashed = BoundedCache(xxhash.xxh3_64_intdigest, cacheable=lambda word: len(word) <= 64)


def word_buckets(words: list[bytes]) -> np.ndarray:
    """How often words and pairs of neighbouring words fall into each bucket."""
    hashes = np.fromiter(map(_hashed.__getitem__, words), np.uint64, len(words))
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    both = np.concatenate([hashes, pairs ^ (pairs >> np.uint64(29))]) % np.uint64(WORD_BUCKETS)
    return np.bincount(both.astype(np.int64), minlength=WORD_BUCKETS)


def text_view(text: str) -> list[float]:
    data = text.encode()
    counts = np.bincount(_KINDS[np.frombuffer(data, np.uint8)], minlength=N_KINDS)
    words, lines = data.split(), data.split(b"\n")
    n, m = max(1, len(words)), max(1, len(lines))
    again = sum(map(operator.eq, words, words[1:]))
    extra = [
        len(set(words)) / math.sqrt(n), again / n, len(data) / n / 10, len(set(lines)) / m, math.log1p(len(data) / m) / 5,
        sum(b" | " in line for line in lines) / m,
    ]
    shares = np.sqrt(word_buckets(words) / (2 * n))
    return [*np.sqrt(counts / max(1, len(data))).tolist(), *shares.tolist(), *extra]


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    out = [0.0] * (2 * BUCKETS)
    for k, value in enumerate((lang, source)):
        out[k * BUCKETS + (0 if value is None else 1 + xxhash.xxh32_intdigest(value) % (BUCKETS - 1))] = 1.0
    size = math.log1p(max(0, n_chars or 0)) / 5
    return [*out, size, size * size]


class Logistic:
    """Ridge logistic regression on standardised columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0):
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])
        weight = np.ones(len(x)) if weight is None else weight
        self.w = np.zeros(z.shape[1])
        penalty = np.full(len(self.w), ridge)
        penalty[-1] = 1e-3
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            slope = z.T @ (weight * (p - y)) + penalty * self.w
            curve = (z * (weight * p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            self.w -= step
            if np.abs(step).max() < 1e-5:
                break

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.spread) @ self.w[:-1] + self.w[-1], -30, 30)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


class CoTrained:
    """Both views, their calibration, the combination and the cut."""

    def __init__(self, views: list[np.ndarray], quality: np.ndarray, pool: list[np.ndarray], held: np.ndarray):
        train = ~held
        x = [v[train] for v in views]
        y = [quality[train]] * 2
        free = [np.arange(len(pool[0]))] * 2
        for _ in range(ROUNDS):
            self.models = [Logistic(x[k], y[k]) for k in (0, 1)]
            if not len(pool[0]):
                break
            for k, other in ((0, 1), (1, 0)):
                p = probability(self.models[k].logit(pool[k][free[k]]))
                sure = np.argsort(-np.abs(p - 0.5), kind="stable")[:PER_ROUND]
                sure = sure[np.maximum(p[sure], 1 - p[sure]) >= SURE]
                rows = free[k][sure]
                x[other] = np.vstack([x[other], pool[other][rows]])
                y[other] = np.append(y[other], (p[sure] > 0.5).astype(float))
                free[k] = np.delete(free[k], sure)
        self.models = [Logistic(x[k], y[k]) for k in (0, 1)]
        checked, truth = [v[held] for v in views], quality[held]
        self.calibrations = [Logistic(self.models[k].logit(checked[k])[:, None], truth) for k in (0, 1)]
        self.combination = Logistic(np.column_stack(self.calibrated(checked)), truth)
        scores = self.scores(checked)[2]
        cuts = np.unique(np.append(scores, 0.0))
        good, bad = np.sort(scores[truth == 1]), np.sort(scores[truth == 0])
        cost = COST_OF_GOOD * np.searchsorted(good, cuts) + len(bad) - np.searchsorted(bad, cuts)
        best = np.flatnonzero(cost == cost.min())
        # in the middle of the gap between what goes and what stays, so that unseen rows near it are not cut
        low = bad[bad < cuts[best[0]]].max(initial=0.0)
        self.cut = (low + cuts[best[0]]) / 2

    def calibrated(self, views: list[np.ndarray]) -> list[np.ndarray]:
        return [self.calibrations[k].logit(self.models[k].logit(views[k])[:, None]) for k in (0, 1)]

    def scores(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by text, by metadata and by both."""
        both = self.calibrated(views)
        return probability(both[0]), probability(both[1]), probability(self.combination.logit(np.column_stack(both)))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars")
    )


def _views(batch, at: int) -> list[np.ndarray]:
    texts, langs, sources, sizes = (batch.column(at + c) for c in range(4))
    return [
        np.array([text_view(t.as_py()) for t in texts]).reshape(batch.num_rows, -1),
        np.array([meta_view(*row) for row in zip(langs.to_pylist(), sources.to_pylist(), sizes.to_pylist())]).reshape(batch.num_rows, -1),
    ]


def fit(docs: DataFrame, labels: DataFrame) -> CoTrained | None:
    """The model, or None if the labels do not hold both classes."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    chosen = truth.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    others = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").orderBy(F.xxhash64("doc_id", F.lit("pool")), "doc_id").limit(POOL)
    others = others.distinct().join(truth, "doc_id", "left_anti").select("doc_id", F.lit(None).cast("int").alias("quality"))
    sample = F.broadcast(chosen.union(others))  # at most LABELLED + POOL ids

    def work(batches):
        for batch in batches:
            views = _views(batch, 2)
            lists = [pa.array(list(v), pa.list_(pa.float64())) for v in views]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "quality", "x", "y"])

    small_batches(docs.sparkSession)
    columns = ("text", "lang", "source", "n_chars")
    # one row for each id, however many rows share it: that bounds what comes to the driver
    rows = _rows(docs).join(sample, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(*columns)).alias("row")).select("doc_id", "quality", "row.*")
    found = rows.mapInArrow(work, "doc_id bigint, quality int, x array<double>, y array<double>").toArrow()
    if not len(found):
        return None
    views = [found.column(c).combine_chunks().flatten().to_numpy().reshape(len(found), -1) for c in ("x", "y")]
    order = np.lexsort((*views[0].T[:3], found.column("doc_id").to_numpy()))
    views = [v[order] for v in views]
    quality = found.column("quality").to_numpy(zero_copy_only=False).astype(float)[order]
    keys = found.column("doc_id").to_numpy()[order]
    known = ~np.isnan(quality)
    held = np.array([xxhash.xxh32_intdigest(int(k).to_bytes(8, "little", signed=True)) % 4 == 0 for k in keys[known]], bool)
    label = quality[known]
    if any(len(np.unique(part)) < 2 for part in (label[held], label[~held])):
        return None
    return CoTrained([v[known] for v in views], label, [v[~known] for v in views], held)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores and kept for each row of ``docs`` (doc_id, text, lang, source, n_chars)."""
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    def work(batches):
        for batch in batches:
            if shared.value is None:
                ones = np.ones(batch.num_rows)
                found, kept = (ones, ones, ones), ones > 0
            else:
                found = shared.value.scores(_views(batch, 1)) if batch.num_rows else (np.empty(0),) * 3
                kept = found[2] >= shared.value.cut
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found), pa.array(kept)], names=["doc_id", "text_score", "meta_score", "score", "kept"])

    return _rows(docs).mapInArrow(work, SCORES)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with the columns of documents."""
    model = fit(docs, labels)
    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    if model is None:
        return whole
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                filled = batch.set_column(1, "text", batch.column(1).fill_null(""))
                kept = shared.value.scores(_views(filled, 1))[2] >= shared.value.cut
                yield batch.filter(pa.array(kept))

    return whole.mapInArrow(work, whole.schema)
