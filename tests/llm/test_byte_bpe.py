import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from propensity.llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.VOCABULARY)


@pytest.fixture(scope="module")
def both():
    ranks = byte_bpe.read_ranks(PATH)
    return byte_bpe.Codec(ranks), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                    special_tokens={})


def test_random_texts(both):
    own, library = both
    rng = random.Random(3)
    parts = ["a", "b", "'s", ".", "1", " ", "  ", "\n", " \n", "\n\n", "\t", "\r", "\xa0", "é", "漢", "😀", "the", "aab"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(8000)]
    for text, ids in zip(texts, own.encode_many(texts)):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_long_pre_tokens(both):
    own, library = both
    for text in ("a" * 50_000, "xyzzy" * 9_000, "!?" * 5_000, " " * 3_000 + "x", "éß" * 4_000):
        assert own.encode(text) == library.encode_ordinary(text)


def test_memo_is_emptied(both):
    own = byte_bpe.Codec(byte_bpe.read_ranks(PATH), known=3)
    for text in ("one two three four", "five six one", "one two"):
        assert own.encode(text) == both[1].encode_ordinary(text)


def test_ranks_that_undercut_each_other():
    """After a merge a pair of lower rank may appear; it goes first."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 290, b"xx": 301, b"xxab": 260}
    own = byte_bpe.Codec(ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcxabab", "xxabab", "abxxabc", "ababababc"):
        assert own.encode(text) == library.encode_ordinary(text)
        assert own.merge(text.encode()) == library.encode_ordinary(text)


def test_rows(spark, both):
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (2, None, "x"), (3, "", None), (None, "a\n b", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string")
    got = sorted(byte_bpe.encode(docs, ids=True).collect(), key=repr)
    assert len(got) == 5
    for r in got:
        text = {1: "the cat", 2: "", 3: "", None: "a\n b"}[r.doc_id]
        ids = both[1].encode_ordinary(text)
        raw = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, bytes(r.ids)) == (len(ids), hashlib.sha256(raw).hexdigest(), raw)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encode(docs.limit(0)).count() == 0
