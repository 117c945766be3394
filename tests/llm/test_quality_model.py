import math
import random

import numpy as np
import xxhash

from tillstar.llm import quality_model

SAMPLE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SAMPLE}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    unseen = {d for d in known if d % 3 == 0}
    shown = labels.where("doc_id % 3 <> 0")
    found = {r.doc_id: r for r in quality_model.classify(docs, shown).collect()}
    assert len(found) == docs.count()
    good = [found[d].kept for d in unseen if known[d] == 1]
    bad = [found[d].kept for d in unseen if known[d] == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05
    again = {r.doc_id: r.score for r in quality_model.classify(docs.repartition(3), shown).collect()}
    assert all(abs(again[d] - r.score) < 1e-6 for d, r in found.items())


def test_special_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, x array<int>"
    rows = [(1, None, None, None, None, "a", None), (1, "", "en", "s", -5, None, [1]), (None, "word " * 50000, "xx", "", 7, None, None), (2, "ok", "en", "s", 2, None, None)]
    docs = spark.createDataFrame(rows, kind)
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    found = quality_model.classify(docs, labels).collect()
    assert [r.kept for r in found] == [True] * 4 and [r.score for r in found] == [1.0] * 4
    assert quality_model.classify(docs.limit(0), labels.limit(0)).count() == 0
    many = [(i, "plain text here" if i % 2 else "### $$$ %%%", "en", None, 10, "", None) for i in range(200)]
    both = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(0, 0)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows + many, kind)
    kept = [r.kept for r in quality_model.classify(docs, both).collect()]
    assert len(kept) == 204 and sum(kept) >= 100
    assert quality_model.keep_good(docs, both).count() == sum(kept)
    assert quality_model.keep_good(docs, both).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def plain_text_view(text):
    """The text view, character by character and word by word."""
    data = text.encode()
    kinds = [0.0] * quality_model.N_KINDS
    marks = [c for c in range(33, 127) if not chr(c).isalnum()]
    for c in data:
        kinds[0 if c > 127 else 2 if 97 <= c <= 122 else 3 if 65 <= c <= 90 else 4 if 48 <= c <= 57 else 5 if c == 32 else 6 if c == 10 else 7 + marks.index(c) if c in marks else 1] += 1
    words, lines = data.split(), data.split(b"\n")
    hashes, size = [xxhash.xxh3_64_intdigest(w) for w in words], max(1, len(words))
    buckets = [0.0] * quality_model.WORD_BUCKETS
    for h in hashes:
        buckets[h % len(buckets)] += 1
    for a, b in zip(hashes, hashes[1:]):
        pair = (a * 0x9E3779B97F4A7C15 + b) % 2**64
        buckets[(pair ^ (pair >> 29)) % len(buckets)] += 1
    extra = [
        len(set(words)) / math.sqrt(size), sum(a == b for a, b in zip(words, words[1:])) / size, len(data) / size / 10, len(set(lines)) / len(lines),
        math.log1p(len(data) / len(lines)) / 5, sum(b" | " in x for x in lines) / len(lines),
    ]
    return [math.sqrt(k / max(1, len(data))) for k in kinds] + [math.sqrt(b / (2 * size)) for b in buckets] + extra


def plain_logit(model, row):
    total = model.w[-1] + sum(w * (x - m) / s for w, x, m, s in zip(model.w, row, model.mean, model.spread))
    return min(30.0, max(-30.0, total))


def test_every_row_of_a_table_is_scored_as_by_hand(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit(docs, labels)
    found = {r.doc_id: r for r in quality_model.classify(docs, labels).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        views = plain_text_view(r.text or ""), quality_model.meta_view(r.lang, r.source, r.n_chars)
        calibrated = [plain_logit(c, [plain_logit(m, v)]) for m, c, v in zip(model.models, model.calibrations, views)]
        score = 1 / (1 + math.exp(-plain_logit(model.combination, calibrated)))
        assert abs(found[r.doc_id].score - score) < 1e-9
        assert found[r.doc_id].kept == (score >= model.cut) or abs(score - model.cut) < 1e-9


def test_the_text_view_sees_words():
    draw = random.Random(1)
    text = "the cat sat on a mat near the door"
    scrambled = list(text.replace(" ", ""))
    draw.shuffle(scrambled)
    letters, other = iter(scrambled), ""
    for c in text:
        other += " " if c == " " else next(letters)
    assert np.abs(np.subtract(quality_model.text_view(text), quality_model.text_view(other))).max() > 0.1
    swapped = "the mat sat on a cat near the door"  # the same words in another order
    assert quality_model.text_view(text) != quality_model.text_view(swapped)


def test_rows_that_share_an_id_are_fitted_once(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "LABELLED", 50)
    monkeypatch.setattr(quality_model, "POOL", 10)
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(7, f"text {i}", "en", "s", 5) for i in range(3000)] + [(i, "plain" if i % 2 else "$$$ ###", "en", "s", 5) for i in range(100, 220)]
    docs = spark.createDataFrame(rows, kind)
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(100, 220)], "doc_id long, quality int")
    seen = []
    with monkeypatch.context() as patch:
        patch.setattr(quality_model, "CoTrained", lambda views, quality, pool, held: seen.append(len(quality) + len(pool[0])))
        quality_model.fit(docs, labels)
    assert 20 < seen[0] <= 60
    assert quality_model.classify(docs, labels).count() == len(rows)
