import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd

from propensity.llm import repeat_index as ri

SF = "/root/testdata/sf0.001"
N = ri.LENGTH


def by_hand(rows):
    """(id, bytes, removed, spans, hash) by a count of all windows."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(raw[s:s + N] for _, raw in raws for s in range(len(raw) - N + 1))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - N + 1):
            if seen[raw[s:s + N]] > 1:
                gone[s:s + N] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def test_longest_matches_around_a_core():
    rng = random.Random(1)
    for _ in range(200):
        def side():
            own = list(b"abcabcabc" * 25)[:rng.choice([0, 5, 100, 190, 191])]
            for _ in range(rng.choice([0, 0, 1, 3])):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(b"\0abc")
            return bytes(own)
        contexts = list({(rng.randint(0, 2), side()[::-1], side()) for _ in range(rng.randint(1, 25))})
        least, most = ri.repeated(*map(list, zip(*contexts)))
        for k, (ask, left, right) in enumerate(contexts):
            hits = [e for e in range(ri.REST + 1) if e <= len(left) and ri.REST - e <= len(right) and any(
                j != k and o[0] == ask and e <= len(o[1]) and ri.REST - e <= len(o[2])
                and left[len(left) - e:] == o[1][len(o[1]) - e:] and right[:ri.REST - e] == o[2][:ri.REST - e]
                for j, o in enumerate(contexts))]
            assert (most[k], least[k] if hits else 0) == (max(hits, default=-1), min(hits, default=0))


def test_every_window_has_one_core_that_moves_with_it():
    rng = random.Random(2)
    raw = bytes(rng.randrange(97, 100) for _ in range(6000))

    def windows(raw, shift=0):
        out = {}
        for side, core, low, high in zip(*(x.tolist() for x in ri.cores(raw))):
            for before in range(low, high + 1):
                start = core - before
                assert 0 <= start and start + N <= len(raw) and 0 <= before <= ri.REST
                assert out.setdefault(start + shift, (side, before)) == (side, before)
        return out
    own = windows(raw)
    assert sorted(own) == list(range(len(raw) - N + 1))
    assert windows(raw[1000:3000], 1000).items() <= own.items()
    assert windows(raw[:N - 1]) == {}
    big, ri.SEGMENT = ri.SEGMENT, 1000
    try:
        assert windows(raw) == own
    finally:
        ri.SEGMENT = big


def cases():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghiéß") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    a, b, passage = text(300), text(300), text(90)
    rows = [a, a, b, b[:700] + "X" + b[701:], text(50) + passage + text(60), passage, text(20) + passage, passage[5:] + text(100),
            "", None, "short", "q" * 3000, "Orre " * 400, text(20) + "Orre " * 90, "x" * 399, "x" * 400, "y" * 401,
            a[:399], a[1:400], text(40) + a[100:499] + text(10), text(40) + a[100:500] + text(10), text(200)]
    for _ in range(12):  # near copies of one text
        c = list(b)
        for _ in range(rng.randint(1, 4)):
            c[rng.randrange(len(c))] = "Z"
        rows.append("".join(c))
    return [(i, t) for i, t in enumerate(rows)]


def test_small_cases(spark):
    rows = cases()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, lo int, context string")
    want = by_hand(rows)
    assert rows_of(ri.digest(docs)) == want
    assert rows_of(ri.digest(docs, many=3)) == want  # the way for crowded questions


def test_repeated_rows_null_ids_and_empty_table(spark):
    long, other = "".join(f"{i} " for i in range(300)), "".join(f"{i}," for i in range(300))
    rows = [(1, long), (1, long), (None, other), (None, other + "z"), (2, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ri.digest(docs)) == by_hand(rows)
    assert ri.digest(docs.limit(0)).count() == 0


def test_whole_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert rows_of(ri.digest(spark.read.parquet(f"{SF}/documents.parquet"))) == by_hand(list(zip(docs.doc_id.tolist(), docs.text)))
