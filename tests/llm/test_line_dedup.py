import random

import pandas as pd

from propensity.llm import line_dedup as ld

SF = "/root/testdata/sf0.001"


def by_hand(rows, similarity=0.8):
    """Removed lines by comparing every line with all earlier ones that share a word."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    seen, by_word, out = [], {}, {}
    for has, i, text in order:
        removed = []
        for no, line in enumerate(text.split("\n") if text else []):
            w = frozenset(x for x in line.lower().replace("\x0b", " ").replace("\x0c", " ").split() if x)
            if w:
                near = {k for x in w for k in by_word.get(x, ())}
                if any(10 * len(w & seen[k]) >= 8 * len(w | seen[k]) for k in near):
                    removed.append(no)
                for x in w:
                    by_word.setdefault(x, []).append(len(seen))
                seen.append(w)
        out[i if has else None] = (len(text.split("\n")) if text else 0, len(removed), removed)
    return sorted(((i, *out[i]) for i, _ in rows), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, list(r.removed)) for r in df.collect()), key=repr)


def test_random_lines(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)] + ["the"] * 10
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 14))] for _ in range(25)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            rng.shuffle(line)
            text.append(rng.choice([" ", "  ", "\t"]).join(line))
        docs.append((i, "\n".join(text)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, " \nThe\nthe the"), (None, "w1 w2 w3"), (104, " ".join(f"v{k}" for k in range(9000)))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, line string, removed int")
    want = by_hand(docs)
    assert rows_of(ld.dedup(df)) == want
    cleaned = ld.clean(df)
    assert cleaned.columns == df.columns
    gone = {i: set(r) for i, _, _, r in want}
    for r in cleaned.collect():
        text = dict(docs)[r.doc_id]
        assert r.text == (text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[r.doc_id]))


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b\nc d\na b"), (1, "a b\nc d\na b"), (2, "c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ld.dedup(df)) == [(1, 3, 1, [2]), (1, 3, 1, [2]), (2, 1, 1, [0])]
    assert ld.dedup(df.limit(0)).count() == 0


def test_whole_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert rows_of(ld.dedup(spark.read.parquet(f"{SF}/documents.parquet"))) == by_hand(list(zip(docs.doc_id.tolist(), docs.text)))


def test_words_are_cut_once(spark):
    docs = spark.createDataFrame([(1, "a b\nc")], "doc_id long, text string")
    plan = ld._sets(ld.lines(docs, "doc_id", "text"), ld._levels(docs, "text"), 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct(") == plan.count("array_remove(") == 1


def test_only_likely_pairs_come_to_words(spark, monkeypatch):
    rng = random.Random(6)
    texts = []
    for i in range(30):
        base = [f"g{i}_{k}" for k in range(40)]
        for changed in (0, 1, 7, 12):
            line = base[changed:] + [f"x{i}_{changed}_{k}" for k in range(changed)]
            rng.shuffle(line)
            texts.append(" ".join(line))
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    kept = {}
    monkeypatch.setattr(ld, "stored", lambda df, label, f=ld.stored: kept.setdefault(label, f(df, label)))
    assert rows_of(ld.dedup(spark.createDataFrame(docs, "doc_id long, text string"))) == by_hand(docs)
    sets = [set(t.split()) for t in texts]
    pairs = {(r.y.id, r.x.id) for r in kept["likely"].collect()}
    assert pairs == {(y, x) for y in range(len(sets)) for x in range(y) if 10 * len(sets[x] & sets[y]) >= 8 * len(sets[x] | sets[y])}
    assert pairs <= {(r.y.id, r.x.id) for r in kept["asked"].collect()}


def test_pairs_grow_with_the_lines_of_a_group(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"g{k}" for k in range(40)]
    texts = []
    for i in range(60):
        line = base[:i % 40] + [f"x{i}"] + base[i % 40 + 1:]
        rng.shuffle(line)
        texts.append(" ".join(line))
    docs = list(enumerate(texts))
    compared = []

    def stored(df, label, f=ld.stored):
        out = f(df, label)
        if label.startswith("likely"):
            compared.append(out.count())
        return out
    monkeypatch.setattr(ld, "stored", stored)
    assert rows_of(ld.dedup(spark.createDataFrame(docs, "doc_id long, text string"))) == by_hand(docs)
    assert 1 <= sum(compared) < len(texts)


def test_sizes_beside_powers_of_two(spark):
    rng = random.Random(9)
    words = [f"v{k}" for k in range(140)]
    texts = [" ".join(words[:k]) for k in range(1, 140)] + [" ".join(words[140 - k:]) for k in (3, 4, 5, 8, 31, 32, 33, 64, 128)]
    rng.shuffle(texts)
    docs = [(k, "\n".join(texts[3 * k:3 * k + 3])) for k in range(50)]
    assert rows_of(ld.dedup(spark.createDataFrame(docs, "doc_id long, text string"))) == by_hand(docs)
