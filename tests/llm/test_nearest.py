import math
import random

import pytest
from pyspark.sql import functions as F

from tillstar.llm import nearest

KIND = "vec_id long, embedding array<float>, rank string, label int"


def brute_force(rows, k):
    usable = {}
    for key, v in rows:
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[key] = min(usable.get(key, v), v)
    out = []
    for q, v in usable.items():
        if q % 20 == 0:
            scored = []
            for c, w in usable.items():
                if c != q and len(w) == len(v):
                    total = 0.0
                    for x, y in zip(v, w):
                        total += x * y
                    scored.append((-total, c))
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def single(x):
    import numpy as np

    return float(np.float32(x))


def found(spark, rows, k=20):
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], KIND)
    return sorted(map(tuple, nearest.nearest(frame, F.col("vec_id") % 20 == 0, k).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 16)
    monkeypatch.setattr(nearest, "CANDIDATE_BLOCK", 100)


def test_equals_brute_force(spark, small_blocks):
    draw = random.Random(5)
    rows = [(i, [single(draw.gauss(0, 1) * 10 ** (i % 4 - 2)) for _ in range(16)]) for i in range(700)]
    rows += [(1000 + i, rows[i % 9][1]) for i in range(60)]  # ties
    assert found(spark, rows) == brute_force(rows, 20)


def test_special_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]),
        (20, [1.0, 2.0, 3.0]), (40, [-1.0, 0.5]), (40, [-1.0, 0.5]), (41, [single(1e-40), 0.0]), (60, [single(1e30), 1.0]), (61, [1.0, 2.0, 3.5]), (80, [5.0]),
    ]
    assert found(spark, rows) == brute_force(rows, 20)
    assert found(spark, []) == []


def test_long_vectors(spark):
    draw = random.Random(6)
    rows = [(i, [single(draw.uniform(-1, 1)) for _ in range(2500)]) for i in range(45)]
    assert found(spark, rows, 5) == brute_force(rows, 5)
