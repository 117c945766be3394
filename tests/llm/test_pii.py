import hashlib
import random
import re

import numpy as np
import pytest

from tillstar.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def plain(text):
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if max(map(int, m[0].split("."))) <= 255]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(only(m[0])) <= 19 and luhn(only(m[0]))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(only(m[0])) <= 15]


CASES = [
    "", "a@b.c", "a@b", "a@b.c@d.e", "a@b.c%x@d.e", "x..@-.-", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.1.1.1 01.2.3.4", "4111111111111111", "4111 1111-1111 1111",
    "41111111111111110", "+1 (555) 010-9999", "+1", "+1 2", "+12345678 (", "++12345678-", "é 4111111111111111 ü@é.de a@é", "1" * 5000, "a" * 5000 + "@b.cc", "+1" + "(" * 5000,
]


def test_rules_equal_the_plain_patterns():
    draw = random.Random(3)
    cases = CASES + ["".join(draw.choice("0123456789..@+ -()ab%_\n") for _ in range(draw.randrange(120))) for _ in range(4000)]
    for text in cases:
        assert pii.rule_spans(text) == plain(text), text


def test_gradient():
    model, draw = pii.Tagger(3), np.random.default_rng(1)
    for name in model.p:
        model.p[name] = model.p[name].astype(np.float64)
    codes = draw.integers(0, pii.N_CLASSES, (7, 3))
    tags = np.array([pii.tags_of(7, [(k, 1, 5)]) for k in range(3)]).T.astype(int)
    _, grad = model.gradient(codes, tags)
    for name, value in model.p.items():
        for at in [tuple(draw.integers(0, n) for n in value.shape) for _ in range(4)]:
            kept = value[at]
            value[at] = kept + 1e-4
            high = model.gradient(codes, tags)[0]
            value[at] = kept - 1e-4
            low = model.gradient(codes, tags)[0]
            value[at] = kept
            assert abs((high - low) / 2e-4 - grad[name][at]) < 2e-3, (name, at)


def test_viterbi_and_marginals_by_enumeration():
    import itertools

    model, draw = pii.Tagger(5), np.random.default_rng(2)
    scores = draw.standard_normal((3, 2, pii.N_TAGS)).astype(np.float32)
    first, follow = model._chain()
    single, _, _ = model.marginals(scores)
    for n in range(2):
        paths = list(itertools.product(range(pii.N_TAGS), repeat=3))
        value = np.array([first[p[0]] + scores[0, n, p[0]] + sum(follow[a, b] + scores[t + 1, n, b] for t, (a, b) in enumerate(itertools.pairwise(p))) for p in paths])
        assert tuple(model.decode(scores)[:, n]) == paths[int(value.argmax())]
        chance = np.exp(value - value.max())
        chance /= chance.sum()
        for t in range(3):
            for tag in range(pii.N_TAGS):
                assert abs(single[t, n, tag] - sum(c for c, p in zip(chance, paths) if p[t] == tag)) < 1e-4


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_tagger_finds_held_out_spans(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[0-9@]'")
    model = pii.fit(corpus.where("doc_id % 2 = 0"))
    texts = [r.text for r in corpus.where("doc_id % 2 = 1").collect() if re.search("[0-9@]", r.text)]
    hit = wanted = made = 0
    for text, found in zip(texts, pii.tagger_spans(model, texts)):
        want, got = set(pii.rule_spans(text)), set(pii.reconcile(found, []))
        hit, wanted, made = hit + len(want & got), wanted + len(want), made + len(got)
    assert wanted > 10 and hit >= 0.6 * wanted and hit >= 0.85 * made


class Marks(pii.Tagger):
    """Scores by character alone: # begins a span, digits and = go on with it."""

    def emissions(self, codes, keep=False):
        tags = np.zeros(pii.N_CLASSES, int)
        tags[pii.encode("#1=")] = [1, 2, 2]
        return 10 * np.eye(pii.N_TAGS, dtype=np.float32)[tags[codes]], None, None


@pytest.mark.parametrize("length", [20, 31, 32, 33, 40, 48, 56, 63, 64, 65, 80, 100, 1000])
def test_spans_of_any_length_at_any_offset(length):
    texts, wanted = [], []
    for inner in ("1" * (length - 1), "=" * (length - 2) + "1", "1" + "=" * (length - 2)):  # one digit: windows without one go on
        for offset in range(pii.STRIDE):
            for after in (0, 40, 300):
                texts.append("y" * (300 + offset) + "#" + inner + "y" * after)
                wanted.append([(0, 300 + offset, 300 + offset + length)])
    assert [[f[1:] for f in found] for found in pii.tagger_spans(Marks(), texts)] == wanted
    assert all(sure > 0.99 for found in pii.tagger_spans(Marks(), texts[:5]) for sure, *_ in found)


def test_sequences_of_different_lengths_side_by_side():
    model, draw = pii.Tagger(5), np.random.default_rng(4)
    parts = [draw.standard_normal((n, pii.N_TAGS)).astype(np.float32) for n in (3, 9, 1, 9, 6)]
    for part, (path, chance) in zip(parts, pii._decoded(model, parts)):
        alone = model.decode(part[:, None])[:, 0]
        assert path.tolist() == alone.tolist()
        if alone.any():
            single = model.marginals(part[:, None])[0][:, 0]
            assert np.allclose(chance, single[np.arange(len(part)), alone], atol=1e-5)


def test_query_and_masking(spark, corpus):
    own = [(-1, None), (-2, ""), (-3, "mail a.b@c.de now, call +49 30 1234567."), (-3, "mail a.b@c.de now, call +49 30 1234567."), (None, "ip 10.0.0.1"), (-4, "x " * 60000 + "a@b.cc")]
    rows = [(d, t, "en", "s", len(t or ""), "clash", 1) for d, t in own]
    docs = corpus.where("doc_id < 300").selectExpr("*", "'x' as spans", "1 as n_email").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, n_email int"))
    found = pii.find(docs).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text or "")
    assert len(found) == docs.count()
    for r in found:
        base = plain(texts[r.doc_id])
        written = [f"{pii.KINDS[k]}:{b}:{e}" for k, b, e in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",") if r.spans else []) and len(r.spans.split(",")) - (not r.spans) == len(base) + r.n_added
    done = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert done[-1].text is None and done[-2].text == "" and done[-3].text == "mail <EMAIL> now, call <PHONE>." and done[-3].n_chars == len(done[-3].text)
    assert pii.find(docs.limit(0)).count() == 0
    assert pii.mask(docs).columns == ["doc_id", "text", "lang", "source", "n_chars"]
