import random
import re
from collections import Counter
from itertools import combinations

import pytest
from conftest import rows

from tillstar.operators import affinity
from tillstar.operators.affinity import top_pairs


def brute_force(lines, top):
    baskets = {}
    for basket, item in lines:
        baskets.setdefault(basket, set()).add(item)
    counts = Counter(pair for items in baskets.values() for pair in combinations(sorted(items), 2))
    best = sorted(counts.items(), key=lambda entry: (-entry[1], entry[0]))[:top]
    return [(a, b, n) for (a, b), n in best]


def found(spark, lines, top=5, small=100, prune=None):
    df = spark.createDataFrame(lines, "o long, p long")
    return [tuple(r) for r in top_pairs(df, "o", "p", top, small, prune).collect()]


def test_pairs_over_small_baskets(spark):
    lines = [(o, p) for o, items in enumerate([(1, 2), (1, 2), (1, 2, 2), (1, 3), (1, 3), (9,)]) for p in items]
    assert found(spark, lines) == [(1, 2, 3), (1, 3, 2)]


@pytest.mark.parametrize("seed", range(4))
def test_large_baskets_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = []
    for basket in range(60):
        size = rng.choice([1, 2, 3, 4, 5])
        lines += [(basket, rng.randrange(40)) for _ in range(size)]
    for basket in range(100, 100 + rng.choice([1, 2, 4])):
        lines += [(basket, p) for p in rng.sample(range(60), rng.choice([12, 30, 60]))]
    assert found(spark, lines, small=8) == brute_force(lines, 5)


def test_one_giant_basket_decides_by_ties(spark):
    lines = [(1, p) for p in range(500, 0, -1)] + [(2, 7), (2, 400)]
    assert found(spark, lines) == brute_force(lines, 5)


def test_only_large_baskets(spark):
    lines = [(b, p) for b in range(3) for p in range(b, 130)]
    assert found(spark, lines) == brute_force(lines, 5)


@pytest.mark.parametrize("small", [3, 100])
def test_rare_items_leave_first(spark, small):
    rng = random.Random(9)
    lines = [(b, p) for b in range(80) for p in {rng.randrange(3), rng.randrange(6), 100 + rng.randrange(300)}]
    assert found(spark, lines, small=small, prune=True) == brute_force(lines, 5)


def test_pruning_with_few_pairs(spark):
    lines = [(1, 1), (1, 2), (2, 3)]
    assert found(spark, lines, prune=True) == [(1, 2, 1)]


@pytest.mark.parametrize("chunk", [7, 1000])
def test_chunks_of_large_baskets(spark, chunk):
    rng = random.Random(chunk)
    lines = [(b, p) for b in range(4) for p in rng.sample(range(80), 50 - b)]
    counts = affinity._pair_counts_in_chunks(spark.createDataFrame(lines, "basket long, item long"), chunk)
    assert sorted(map(tuple, counts.collect())) == sorted(brute_force(lines, 10**6))


@pytest.mark.parametrize("prune", [False, True])
def test_tasks_grow_with_lines_and_pairs(spark, monkeypatch, prune):
    monkeypatch.setattr(affinity, "LINES_PER_TASK", 100, raising=False)
    monkeypatch.setattr(affinity, "PAIRS_PER_TASK", 50, raising=False)
    rng = random.Random(5)
    lines = [(b, p) for b in range(200) for p in [1, 2, *rng.sample(range(3, 400), 3)]]
    best = top_pairs(spark.createDataFrame(lines, "o long, p long"), "o", "p", 5, 100, prune)
    assert [tuple(r) for r in best.collect()] == brute_force(lines, 5)
    dealt = re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", best._jdf.queryExecution().executedPlan().toString())
    assert dealt and all(int(n) > 4 for n in dealt)  # more than the shuffle partitions of these tests
    assert prune or set(map(int, dealt)) == {41}  # 2000 pairs
