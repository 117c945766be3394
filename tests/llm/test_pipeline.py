import base64
import re
from collections import Counter
from hashlib import sha256

import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.test_near_dedup import brute_force
from tillstar.llm import bpe, mixing, near_dedup, pii, quality_model, stages

SMALL = "/root/testdata/sf0.001"
COLUMNS = list(stages.COLUMNS)


def bag(frame):
    return Counter(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "deduplicate", "mask_personal_data", "mix_sources", "encode"]
    stage = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")

    good = corpus_pipeline.stored(stage["quality"](spark, docs, SMALL), "test")
    kept = {r.doc_id for r in quality_model.classify(docs, labels).where("kept").collect()}
    assert bag(good) == Counter({k: v for k, v in bag(docs).items() if k[0] in kept})

    single = corpus_pipeline.stored(stage["deduplicate"](spark, good, SMALL), "test")
    stay = {r.doc_id for r in near_dedup.near_duplicates(good, k=5, percent=80).where("kept").collect()}
    assert bag(single) == Counter({k: v for k, v in bag(good).items() if k[0] in stay})

    masked = corpus_pipeline.stored(stage["mask_personal_data"](spark, single, SMALL), "test")
    before = {r.doc_id: r.text for r in single.collect()}
    for r in masked.collect():
        assert not pii.rule_spans(r.text) and r.n_chars == len(r.text)
        pieces = re.split("<(?:EMAIL|IP|CARD|PHONE)>", r.text)
        assert len(pieces) == 1 or all(p in before[r.doc_id] for p in pieces)
    assert {r.doc_id for r in masked.collect()} == set(before)

    mixed = corpus_pipeline.stored(stage["mix_sources"](spark, masked, SMALL), "test")
    times = {r.doc_id: r.repeats for r in mixing.mix(masked).collect()}
    want = Counter()
    for row, n in bag(masked).items():
        want[row] += n * times[row[0]]
    assert bag(mixed) == +want

    done = stage["encode"](spark, mixed, SMALL)
    coder = bpe.ByteBpe(bpe.rank_bytes())
    want = Counter()
    for (key, text, *_), n in bag(mixed).items():
        want[key, len(coder.encode_many([text])[0])] += n
    assert Counter((r.doc_id, r.n_tokens) for r in done.collect()) == want
    assert done.count() == corpus_pipeline.run(spark, SMALL).count()


def test_special_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, size int, repeats string, component_id long"
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two a@b.cc", "en", "a", 14), (3, "one two a@b.cc", "en", "a", 14), (None, "x y", None, "a", 3), (None, None, "de", None, 0)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], kind)
    assert stages.deduplicate(spark, docs, SMALL).count() == 5
    assert bag(stages.mask_personal_data(spark, docs, SMALL))[(3, "one two <EMAIL>", "en", "a", 15)] == 2
    assert stages.mix_sources(spark, docs, SMALL).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_stages_equal_plain_versions(spark):
    """Near duplicates by comparing all pairs, encodings by the tokenizer library."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    kept = {key for key, _, _, stays in brute_force([(r.doc_id, r.text) for r in rows], 5, 80) if stays}
    assert {r.doc_id for r in stages.deduplicate(spark, docs, SMALL).collect()} == kept and len(kept) < len(rows)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages.encode(spark, docs, SMALL).collect()}
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        want = len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256((r.text or "").encode()).hexdigest()
        assert found[r.doc_id] == want


def test_a_very_long_text_passes_every_stage(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i}" for i in range(60_000)) + " mail me@example.org"
    docs = spark.createDataFrame([(1, long, "en", "a", len(long)), (2, "short text", "en", "a", 10)], kind)
    assert {r.doc_id for r in stages.deduplicate(spark, docs, SMALL).collect()} == {1, 2}
    masked = {r.doc_id: r.text for r in stages.mask_personal_data(spark, docs, SMALL).collect()}
    assert masked[1].endswith("<EMAIL>") and masked[1].startswith("word0 word1 ")
    assert {r.doc_id for r in stages.encode(spark, docs, SMALL).collect()} == {1, 2}
