import zlib

import numpy as np
import pandas as pd
import pytest

from propensity.llm import quality, toxicity
from propensity.llm.hashed import Points, sampled

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def marked():
    return pd.read_parquet(f"{SF}/documents.parquet").merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")


def split(df, parts, left_out, rows):
    held = df.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % parts == left_out)
    return df[~held].head(rows), df[held]


def auc(scores, labels):
    rank = pd.Series(scores).rank().to_numpy()
    one = labels == 1
    return (rank[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())


def test_quality_on_held_out_rows(marked):
    train, test = split(marked, 3, 1, 1200)
    model = quality.train([(b, n, y) for (b, n), y in zip(quality.counted(train.text.tolist()), train.quality)])
    scores = model.scores(test.text.tolist())
    assert auc(scores, test.quality.to_numpy()) > 0.98
    assert ((scores >= 0.5) == test.quality).mean() > 0.95


def test_toxicity_on_held_out_rows(marked):
    train, test = split(marked, 4, 2, 3000)
    model = toxicity.train([(np.unique(toxicity.terms([t])[0]), y) for t, y in zip(train.text, train.toxic)])
    scores = model.scores(test.text.tolist())
    assert auc(scores, test.toxic.to_numpy()) > 0.95
    chosen = scores >= 0.3
    assert test.toxic[chosen].mean() > 0.9 and chosen[test.toxic == 1].mean() > 0.8


def test_pairs_of_terms_count():
    """Neither term says anything alone; together they do."""
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        noise = [f"w{k}" for k in rng.integers(0, 50, 6)]
        words = noise + ["insult"] * a + ["group"] * b
        rows.append((np.unique(toxicity.terms([" ".join(words)])[0]), int(a == b)))
    model = toxicity.train(rows, epochs=40, least=0)
    texts = ["insult group w1", "w1 w2", "insult w1", "group w1"]
    low = model.scores(texts[2:]).max()
    assert model.scores(texts[:2]).min() > 0.6 > 0.4 > low


def test_pairs_of_terms_count_at_the_defaults():
    """An insult says nothing by itself; with a group it is toxic, without one it is not."""
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        toxic = int(a == b) if a else int(rng.random() < 0.5)
        words = [f"w{k}" for k in rng.integers(0, 50, 6)] + ["insult"] * a + ["group"] * b
        rows.append((np.unique(toxicity.terms([" ".join(words)])[0]), toxic))
    model = toxicity.train(rows)
    both, insult = model.scores(["insult group w1", "insult w1"])
    assert both > 0.8 and insult < 0.2


def by_hand(model, text):
    """Score of one text from weights and all pairs of its known terms."""
    has = set(toxicity.terms([text])[0].tolist())
    at = [k for k, b in enumerate(model.buckets.tolist()) if b in has]
    margin = model.bias + sum(model.weight[k] for k in at)
    margin += sum(model.latent[i] @ model.latent[j] for i in at for j in at if i < j)
    return 1 / (1 + np.exp(-margin))


def test_scores_are_those_of_all_pairs(marked):
    train, test = split(marked, 4, 2, 400)
    model = toxicity.train([(np.unique(toxicity.terms([t])[0]), y) for t, y in zip(train.text, train.toxic)], least=6.0)
    texts = [*test.text.head(60), "", "x"]
    assert len(model.buckets) > 5 and np.allclose(model.scores(texts), [by_hand(model, t) for t in texts])


def test_telling_pairs_in_blocks():
    """Against every pair counted by itself; blocks do not matter."""
    rng = np.random.default_rng(3)
    data = []
    for _ in range(400):
        has = np.flatnonzero(rng.random(24) < 0.4)
        data.append((has * 10, int((3 in has) == (17 in has)) if rng.random() < 0.9 else 0))
    n, n1 = len(data), sum(y for _, y in data)

    def statistic(*wanted):
        seen = [y for b, y in data if set(wanted) <= set(b.tolist())]
        return float(toxicity.ratio(np.array(float(sum(seen))), np.array(float(len(seen))), n1, n))
    want = {b for b in range(0, 240, 10) if statistic(b) >= 15}
    for a in range(0, 240, 10):
        for b in range(a + 10, 240, 10):
            if statistic(a, b) - statistic(a) - statistic(b) >= 40:
                want |= {a, b}
    assert {30, 170} <= want
    for block in (5, 512):
        assert set(toxicity.telling(data, 15.0, block=block).tolist()) == want


def test_scores_do_not_depend_on_the_batch():
    texts = ["", "a", "Der Haus", "a a a", "x" * 5000, "é 漢\n\nb !!"] * 3
    rows = [(b, n, i % 2) for i, (b, n) in enumerate(quality.counted(texts))]
    model = quality.train(rows, least=1)
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])
    fm = toxicity.train([(np.unique(toxicity.terms([t])[0]), i % 2) for i, t in enumerate(texts)], least=0)
    assert np.allclose(fm.scores(texts), [fm.scores([t])[0] for t in texts])
    for m in (model, fm):
        assert m.scores([]).tolist() == []


def test_hashes_of_runs_depend_on_the_run_only():
    p, q = Points(["ab cd ab", "ab"]), Points(["zz", "cd"])
    starts, ends = p.runs(~p.space)
    h = p.run_hashes(p.code, starts, ends)
    assert h[0] == h[2] == h[3] != h[1]
    starts, ends = q.runs(~q.space)
    assert q.run_hashes(q.code, starts, ends)[1] == h[1]
    assert p.text_of(p.runs(~p.space)[0]).tolist() == [0, 0, 0, 1]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_rows(spark, module):
    rows = [(1, "good day", "x"), (1, "good day", "x"), (2, None, "x"), (3, "", "x"), (None, "bad day", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, None), (None, 1, 1), (9, 0, 1), (3, 2, -1)],
                                   "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, module.score(docs, labels).collect()), key=repr)
    assert [r[0] for r in got] == [1, 1, 2, 3, None] and got[0] == got[1]
    for i, held, score, predicted in got:
        assert held == (i is not None and zlib.crc32(str(i).encode()) % module.PARTS == module.LEFT_OUT)
        assert 0 <= score <= 1 and predicted == int(score >= (0.5 if module is quality else 0.3))
    none = module.score(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert module.score(docs.limit(0), labels).count() == 0


def test_keep_clean(spark):
    texts = [(i, ("you moron " if i % 4 == 0 else "you friend ") + f"w{i}", i) for i in range(400)]
    docs = spark.createDataFrame([*texts, (None, None, 1)], "doc_id long, text string, _text int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    left = toxicity.keep_clean(docs, labels)
    assert left.columns == docs.columns and all(r._text == r.doc_id for r in left.collect() if r.doc_id is not None)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([*(i for i in range(400) if i % 4), None], key=repr)


def test_sampled_is_bounded_by_rows_among_the_documents(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, "a text")] * 30 + [(8, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, toxic int")
    kept = {i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2}
    got = {r.id: (r.text, r.label) for r in sampled(docs, labels, "toxic", 100, 4, 2).collect()}
    assert set(got) == kept and sampled(docs, labels, "toxic", 100, 4, 2).count() == len(kept)
    assert all(got[i] == ({7: "a text", 8: ""}.get(i, f"text {i}"), i % 2) for i in kept)
    assert sampled(docs, labels, "toxic", 5, 4, 2).count() == 5
