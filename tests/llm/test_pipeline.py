import hashlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from propensity.llm import byte_bpe, toxicity
from propensity.llm.queries import QUERIES
from test_decontaminate import by_hand as leaks_by_hand
from test_simhash import kept_by_hand as least_by_hand

SF = "/root/testdata/sf0.001"


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]


@pytest.fixture(scope="module")
def kept_by_hand(spark):
    """Stage by stage over plain Python; the toxicity model is the operator's own."""
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = docs[model.scores(docs.text.fillna("").tolist()) < 0.3]
    body = docs.text.str.replace("[\\x20\\x09-\\x0D]", "", regex=True)
    docs = docs.assign(body=body, points=-docs.text.str.len()).sort_values(["points", "doc_id"]).drop_duplicates("body")
    docs = docs[docs.doc_id.isin(least_by_hand(list(zip(docs.doc_id.tolist(), docs.text))))]
    pairs = list(zip(items.item_id.tolist(), items.text))
    return docs[[not leaks_by_hand(t, pairs) for t in docs.text]]


def test_whole_table(spark, kept_by_hand):
    got = {r.doc_id: r for r in QUERIES["pipeline"](spark, SF).collect()}
    assert set(got) == set(kept_by_hand.doc_id)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY)))
    for i, text in zip(kept_by_hand.doc_id, kept_by_hand.text):
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    rows = [(1, None, None, "s", 0), (2, "", "en", None, 0), (3, "a b c", None, "s", None), (3, "a b c", None, "s", None),
            (None, "d e f", "en", "s", 5), (4, "long " * 30_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, SF)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            assert out.count() <= given.count()
