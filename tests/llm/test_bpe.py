import base64
import hashlib
import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tillstar.llm import bpe  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(bpe.rank_bytes())


SPECIAL = [
    "", " ", "  ", "\n", " \n", "a", "it's", "it's's", "it 's", "'s", "''s", "\n's", "\n'll be", "'re'rx", "'r", "'", "we've!'s", "!'d", " 'm",
    "a  b", "a \n b", "a\n\nb", "end  ", "x y", "x  y", "x  y", "1's2", "abc123 !?", "<|endoftext|>", "日本語 テスト", "é́", "😀'll",
    "a" * 5000, " " * 3000, "'" * 999 + "s", "ab" * 3000 + "\n", "1" * 4000,
]


def test_equals_the_library_on_special_texts(coder, reference):
    ids = coder.encode_many(SPECIAL)
    assert ids == [reference.encode_ordinary(t) for t in SPECIAL]
    assert [coder.decode(i) for i in ids] == [t.encode() for t in SPECIAL]


def test_equals_the_library_on_random_texts(coder, reference):
    draw = random.Random(1)
    alphabet = list("abst mdrevl'  \n\t1 2!?.") + ["é", "ß", " ", "٣", "漢", "😀", "\x00", "\x85"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(200))) for _ in range(1500)]
    assert coder.encode_many(texts) == [reference.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_class_that_the_library_gives_it():
    """A pattern of one class encodes a character or nothing."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for kind, pattern in ((bpe.LETTER, r"\p{L}"), (bpe.NUMBER, r"\p{N}"), (bpe.SPACES, r"\s")):
        only = tiktoken.Encoding("one", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        assert [c for c in points if only.encode_ordinary(chr(c))] == [c for c in points if bpe.classes()[c] == kind]


def test_letters_and_numbers_of_the_newest_version(coder, reference):
    added = [chr(c) for first, last in bpe.NEW_LETTERS + bpe.NEW_NUMBERS for c in (first, last)]
    texts = [f"a{c}b 1{c}2 {c}{c}!{c} 's{c}" for c in added]
    assert coder.encode_many(texts) == [reference.encode_ordinary(t) for t in texts]


def test_query_rows(spark, coder, reference):
    rows = [(1, "It's 12 o'clock.\n", "x"), (2, None, "y"), (3, "", "z"), (1, "It's 12 o'clock.\n", "x"), (None, "a b", None), (4, "w " * 40000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, bpe.encoding_digests(docs).collect()), key=repr)

    def expected(key, text):
        ids = reference.encode_ordinary(text or "")
        return key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert found == sorted((expected(k, t) for k, t, _ in rows), key=repr)
    assert bpe.encoding_digests(docs.limit(0)).count() == 0
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.encode_documents(docs).collect()}
    assert back == {1: "It's 12 o'clock.\n", 2: "", 3: "", None: "a b", 4: "w " * 40000}
