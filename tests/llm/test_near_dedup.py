import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tillstar.llm import near_dedup

KIND = "doc_id long, text string, component_id string, node int, bands string"


def brute_force(rows, k, percent):
    """Component and set size of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        width = min(k, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            linked = sets[i] and sets[j] and (a == b or 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))
            if linked and None not in (a, b):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(((d, len(s), d if d is None else find(d), d is None or d == find(d)) for (d, _), s in zip(rows, sets)), key=repr)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(d, t, "x", 1, None) for d, t in rows], KIND)
    return sorted(map(tuple, near_dedup.near_duplicates(docs, **how).collect()), key=repr)


def corpus(seed, families, singles):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(1, 120))) for _ in range(singles)]
    for _ in range(families):
        words = draw.choices(vocabulary, k=draw.randrange(60, 300))
        for _ in range(draw.randrange(2, 25)):
            copy = list(words)
            for _ in range(draw.randrange(0, max(2, len(words) // 14))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append((" " if draw.random() < 0.5 else "\n").join(w.upper() if draw.random() < 0.1 else w for w in copy))
            if draw.random() < 0.2:
                words = copy  # families drift: chains of links
    draw.shuffle(texts)
    return list(enumerate(texts, 7))


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    rows = corpus(3 + k, 12, 60)
    assert found(spark, rows, k=k, percent=percent) == brute_force(rows, k, percent)


def test_special_rows(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Ä b c d"), (8, "ä b c d"), (9, long), (10, long + " end"),
        (11, "x y z q"), (11, "x y z q"), (12, "x y z q"), (12, "other words are here"), (13, "other words are here"), (None, "x y z q"), (None, None),
    ]
    assert found(spark, rows) == brute_force(rows, 3, 85)
    assert found(spark, []) == []


@pytest.mark.parametrize("nodes, shingles", [(2048, 1 << 22), (4, 1 << 22), (2048, 800)])
def test_buckets_with_several_components_lose_no_link(spark, monkeypatch, nodes, shingles):
    """Two families meet in bands; a far member of each links them although their centres are not linked."""
    monkeypatch.setattr(near_dedup, "CHUNK", nodes)
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", shingles)
    base = [f"b{i}" for i in range(200)]

    def variant(*changed):
        return " ".join(f"c{i}" if i in changed else w for i, w in enumerate(base))

    rows = [(i, variant(*range(0, 4 * i, 4))) for i in range(14)]
    rows += [(100 + i, variant(*range(0, 4 * i, 4), 199 - i)) for i in range(14)]
    assert found(spark, rows) == brute_force(rows, 3, 85)


def test_least_matches_keeps_pairs_at_the_threshold():
    for n in (20, 60, 140):
        m = near_dedup.least_matches(n, 0.85, 1e-7)
        assert 0 <= m < 0.85 * n


def test_links_in_a_cell_are_found_by_full_hashes():
    """17 of 20 members are shared, and two of the shared ones agree in their upper halves."""
    shared = [(1 << 40) | 1, (1 << 40) | 2, *(k << 33 for k in range(3, 18))]
    sets = [np.array(sorted([*shared, 5]), np.uint64), np.array(sorted([*shared, 1 << 60, 1 << 61]), np.uint64)]
    own = near_dedup.Shingler(3, near_dedup.bands_for(85))
    same = own.signature(sets[0]).tobytes()
    rows = pa.table({
        "node": [1, 2], "label": [1, 2], "chunk": [0, 0], "low": [0, 0], "high": [0, 0], "sig": [same, same], "members": [s.tobytes() for s in sets],
        "band": [int(near_dedup._band_keys(own.signature(sets[0]))[0])] * 2,
    })
    looks = near_dedup._looks(near_dedup.bands_for(85) * near_dedup.ROWS, 0.85, near_dedup.MISS)
    assert near_dedup._links_in_cell(rows, 85, looks) == ([1], [2])
    assert near_dedup._links_in_cell(rows, 86, looks) == ([], [])
