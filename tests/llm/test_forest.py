import math
import random

import numpy as np
import pytest

from tillstar.llm import forest

KIND = "vec_id long, embedding array<float>, label int, node long, tag string, path int, own int"


def brute_force(rows, threshold=0.95):
    fit = [k is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for k, v in rows]
    unit = [forest._unit(np.array([v], np.float32))[0] if ok else None for (_, v), ok in zip(rows, fit)]
    near = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if fit[i] and fit[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
                near[i].append(j)
                near[j].append(i)
    label = {k: k for k, _ in rows if k is not None}
    changed = True
    while changed:
        changed = False
        for i, others in enumerate(near):
            for j in others:
                a, b = rows[i][0], rows[j][0]
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
    return sorted(((k, len(n), label.get(k), k is None or label[k] == k) for (k, _), n in zip(rows, near)), key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(k, v, 1, 7, "t", 3, 4) for k, v in rows], KIND)
    return sorted(map(tuple, forest.near_duplicates(frame).collect()), key=repr)


def groups(count, copies, noise, dim=16, seed=3):
    """Rows around ``count`` random vectors."""
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        centre = draw.standard_normal(dim)
        for _ in range(copies):
            out.append([float(np.float32(x)) for x in centre + noise * draw.standard_normal(dim)])
    return list(enumerate(out))


@pytest.fixture
def small_leaves(monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 32)
    monkeypatch.setattr(forest, "SAMPLE", 64)


def test_equals_brute_force_over_several_rounds(spark, small_leaves):
    rows = groups(60, 6, 0.12)
    ours, truth = found(spark, rows), brute_force(rows)
    links = sum(r[1] for r in truth)
    assert links > 300
    # no pair is counted twice or without being a link; hardly any is missed
    assert all(a[1] <= b[1] for a, b in zip(ours, truth))
    assert sum(r[1] for r in ours) >= 0.99 * links
    assert sum(a == b for a, b in zip(ours, truth)) >= 0.97 * len(rows)


def test_a_dense_group_larger_than_a_leaf_is_compared_whole(spark, small_leaves):
    rows = groups(1, 150, 0.0005) + [(k + 1000, v) for k, v in groups(20, 3, 0.3, seed=5)]
    ours, truth = found(spark, rows), brute_force(rows)
    dense = [r for r in ours if r[0] < 150]
    assert all(r[1:] == (149, 0, r[0] == 0) for r in dense)
    assert all(a[1] <= b[1] for a, b in zip(ours, truth))


def test_copies_and_special_rows(spark):
    draw = random.Random(1)
    base = [float(np.float32(draw.gauss(0, 1))) for _ in range(8)]
    rows = [(k, base) for k in range(3, 40)] + [(2, [2 * x for x in base]), (100, [-x for x in base]), (41, base[:4]), (40, base[:4])]
    rows += [(50, None), (51, []), (52, [0.0] * 8), (53, [math.nan] * 8), (54, [math.inf] + base[1:]), (55, [None] + base[1:]), (None, base)]
    rows += [(3, [-x for x in base]), (3, base), (60, [1e-30] * 8), (61, [1e-30] * 8)]  # an id with two different vectors
    assert found(spark, rows) == brute_force(rows)


def test_doubles_and_empty_table(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1e200, 1e199])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, forest.near_duplicates(frame).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert found(spark, []) == []


def test_recall_of_links_at_the_threshold(spark, monkeypatch):
    """All 2,000 given vectors, each with a partner of cosine 0.951, in small leaves."""
    monkeypatch.setattr(forest, "LEAF", 128)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    given = forest._unit(np.array([r[0] for r in table.select("embedding").collect()], np.float32))
    aside = np.random.default_rng(8).standard_normal(given.shape)
    aside = forest._unit(aside - (aside * given).sum(axis=1, keepdims=True) * given)
    every = np.concatenate([given, 0.951 * given + (1 - 0.951**2) ** 0.5 * aside]).astype(np.float32)
    unit = forest._unit(every)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert links.sum() >= 4000
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(every.tolist())], "vec_id long, embedding array<float>")
    ours = {r["vec_id"]: r["n_links"] for r in forest.near_duplicates(frame).collect()}
    assert all(ours[k] <= n for k, n in enumerate(links))
    assert sum(ours.values()) >= 0.99 * links.sum()
