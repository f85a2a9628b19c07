from collections import Counter

import pandas as pd

from propensity.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"


def counts(words):
    width = min(len(words), 5)
    return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if words else Counter()


def by_hand(text, items):
    """Best similarity of any item-sized window, for each item of 0.8 or more."""
    words = (text or "").lower().split()
    out = {}
    for i, item in items:
        own = (item or "").lower().split()
        if not own:
            continue
        a, size = counts(own), len(own)
        for s in range(max(1, len(words) - size + 1)):
            b = words[s:s + size]
            b = counts(b) if len(own) >= 5 else Counter([tuple(b)]) if len(b) == size else Counter()
            if len(own) >= 5 and len(words[s:s + size]) < 5:
                continue
            common = sum((a & b).values())
            got = common / (sum(a.values()) + sum(b.values()) - common)
            if got >= 0.8:
                out[i] = max(out.get(i, 0), got)
    return out


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.contaminated, tuple(r["items"]), round(r.similarity, 9)) for r in dc.judge(d, b).collect()), key=repr)
    want = []
    for i, t in docs:
        found = by_hand(t, items)
        want.append((i, bool(found), tuple(sorted(found)), round(max(found.values(), default=0.0), 9)))
    assert got == sorted(want, key=repr)
    left = dc.keep_clean(d, b)
    assert left.columns == d.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((w[0] for w in want if not w[1]), key=repr)


def test_small_cases(spark):
    w = [f"w{i}" for i in range(60)]
    j = " ".join
    items = [(1, j(w[:30])), (2, j(w[:30]).upper()), (3, "one two three"), (4, ""), (5, None), (6, j(["a"] * 20)), (7, j(w[30:50]))]
    docs = [(1, j(["x"] * 40 + w[:30] + ["y"] * 40)), (2, j(w[:15] + ["z"] + w[15:30])), (3, j(w[:27])), (4, j(w[:20])),
            (5, "so one  two\nthree it is"), (6, "one two"), (7, None), (8, ""), (9, j(["a"] * 200)), (10, j(["a"] * 18)),
            (11, j(w[:30] + w[30:50])), (1, j(["x"] * 40 + w[:30] + ["y"] * 40)), (None, j(w[:30])), (12, j(w[:28] + ["q"] + w[29:50])),
            (13, "x " * 30_000 + j(w[30:50])), (14, j(w[:30][::-1]))]
    check(spark, docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert [tuple(r) for r in dc.judge(d, b.limit(0)).collect()] == [(1, False, [], 0.0)]
    assert dc.judge(d.limit(0), b).count() == 0 and dc.keep_clean(d.limit(0), b).count() == 0


def test_whole_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    check(spark, list(zip(docs.doc_id.tolist(), docs.text)), list(zip(items.item_id.tolist(), items.text)))


def test_both_ways_to_a_fingerprint(spark):
    from pyspark.sql import functions as F

    df = spark.range(50).withColumn("h", F.transform(F.sequence(F.lit(0), F.col("id") % 9), lambda i: F.xxhash64("id", i)))
    one = {r.id: r.f for r in df.select("id", dc.fingerprint(F.col("h")).alias("f")).collect()}
    assert {r.id: r.f for r in dc.fingerprints(df, ["id"], "h", "f").collect()} == one and len(set(one.values())) > 40
