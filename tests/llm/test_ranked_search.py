import math
import random
import re
from collections import Counter

import pytest

from tillstar.llm import ranked_search

DOCS = "doc_id long, text string, lang string, row long, n long, term string, block int"
ITEMS = "item_id long, text string, term string, w int"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_force(docs, items, k):
    counted = [(key, Counter(terms(text))) for key, text in docs]
    sizes = [c.total() for _, c in counted]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    texts = {}
    for key, text in items:
        texts[key] = min((t for t in (text, texts.get(key)) if t is not None), default=None)
    out = []
    for item, text in texts.items():
        scored = []
        for (key, c), n in zip(counted, sizes):
            score = 0
            for t in terms(text):
                if t in c:
                    m = 75 + (25 * n * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, rank, None if null else key, -s) for rank, (s, null, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=5):
    left = spark.createDataFrame([(i, t, "en", 1, 2, "x", 3) for i, t in docs], DOCS)
    right = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    return sorted(map(tuple, ranked_search.search(left, right, k).collect()), key=repr)


def invented(seed, count, least=0, most=60):
    draw = random.Random(seed)
    vocabulary = [f"w{int(draw.paretovariate(0.4))}" for _ in range(3000)]
    return [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(least, most)))) for k in range(count)]


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(ranked_search, "SHARD", 64)
    monkeypatch.setattr(ranked_search, "BLOCK", 7)
    docs, items = invented(1, 400), invented(2, 25, 1, 30)
    assert found(spark, docs, items, k) == brute_force(docs, items, k)


def test_without_a_list_of_frequent_terms(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "FREQUENT", 3)
    docs, items = invented(3, 200), invented(4, 10, 1, 30)
    assert found(spark, docs, items) == brute_force(docs, items, 5)


def test_a_filter_that_lets_everything_through(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "FILTER_BITS", 64)
    docs, items = invented(5, 200), invented(6, 10, 1, 30)
    assert found(spark, docs, items) == brute_force(docs, items, 5)


def test_special_rows(spark):
    docs = [
        (1, None), (2, ""), (3, "., !"), (4, "Été ÉTÉ a_b"), (5, "x " * 200_000 + "rare"), (6, "a b"), (6, "a b"), (None, "a b"), (7, "a b"), (8, "\x00\x7fa\x1fb"), (9, "日本語 a"),
    ]
    items = [(1, "A B rare été"), (2, None), (3, "nothing here"), (None, "a"), (4, "b b b"), (4, "a"), (5, "日本語"), (6, "É ÉTÉ")]
    for k in (3, 20):
        assert found(spark, docs, items, k) == brute_force(docs, items, k)


def test_many_equal_documents(spark):
    docs = [(k, "same words here") for k in range(300)] + [(1000 + k, "same") for k in range(5)]
    assert found(spark, docs, [(0, "same words")], 7) == brute_force(docs, [(0, "same words")], 7)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
