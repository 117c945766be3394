from tillstar.llm import mixing


def fill(sizes, percent=150, epochs=2):
    """Water-filling source by source."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left = sum(sizes.values()) * percent / 100 - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        share = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= epochs * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(epochs * sizes[s]) for s in over}


def rows_of(spark, rows):
    docs = spark.createDataFrame([(d, s, t, 1, "x") for d, s, t in rows], "doc_id long, source string, text string, size int, target string")
    return docs, mixing.mix(docs).collect()


def test_targets_and_totals(spark):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", "w " * (i * 37 % 90 + 1)) for i in range(900)] + [(5000 + i, None, "a b") for i in range(40)]
    rows += [(6000, "Z", "one two"), (6001, "é", "one"), (6002, "empty", None), (6003, "empty", "")]
    docs, found = rows_of(spark, rows)
    sizes = {}
    for d, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes)
    assert len(found) == len(rows)
    taken, largest = {}, {}
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.size * r.repeats and 0 <= r.repeats <= 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=repr) == sorted(map(tuple, found), key=repr)


def test_special_rows(spark):
    docs, found = rows_of(spark, [(1, "a", None), (1, "a", "x y"), (1, "a", "x y"), (None, None, "long " * 50000), (None, None, None)])
    assert len(found) == 5
    assert mixing.mix(docs.limit(0)).count() == 0
    _, found = rows_of(spark, [(1, None, None)])
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)]
