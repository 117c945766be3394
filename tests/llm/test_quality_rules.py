import re

from tillstar.llm import quality_rules


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None, "", " \n\t ", "a", "a a a a a", "a b c a b c", "x#y *$% <&>|", "é ü ß 😀", "l\nl\n l\nl\n\n \nl", "a b c d " * 20, " ".join(f"w{i}" for i in range(60)),
    "\n".join(f"w{i} w{i} w{i}" for i in range(60)), " ".join(f"w{i % 5000}" for i in range(20000)), "\x0b\x0c\r x\x0by z", "# " * 300,
]


def test_figures(spark):
    rows = [(i, t, "en", "clash", 3) for i, t in enumerate(TEXTS)] + [(None, "a b", None, None, None), (3, "a", "en", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, words string, kept int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = quality_rules.judge(docs, labels).collect()
    want = sorted(((d, *expected(t), not expected(t)[-1]) for d, t, *_ in rows), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_binomial_bound(spark):
    import math

    rows = [(0, 10), (3, 40), (7, 1000), (0, 2000), (55, 4000)]
    frame = spark.createDataFrame(rows, "k long, n long").withColumn("p", quality_rules.binomial_cdf("k", "n", 0.02))
    for r in frame.collect():
        exact = sum(math.comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1))
        assert math.isclose(r.p, exact, rel_tol=1e-9)


def test_cutoffs_reject_junk_and_keep_good_documents(spark):
    plain = " ".join(f"w{i}" for i in range(80))
    rows = [(i, plain + f" z{i}", "en") for i in range(1500)] + [(2000 + i, plain + " ###" * (20 + i % 5), "en") for i in range(200)]
    rows += [(3000 + i, plain + " ###" * 30, "de") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, int(d < 2000)) for d, *_ in rows] + [(1, 1), (None, 0), (5, None)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert all(kept[i] for i in range(1500))
    assert not any(kept[2000 + i] for i in range(200))
    assert all(kept[3000 + i] for i in range(20))  # too few good documents of that language to certify any cutoff
