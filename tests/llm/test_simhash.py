import random
import re

import pandas as pd
import xxhash

from propensity.llm import simhash
from propensity.llm.components import components

SF = "/root/testdata/sf0.01"


def by_hand(text, width=3):
    words = [w for w in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints():
    texts = ["", " \n", "a", "A b", "a B  c", "É é\xa0x y z", "the cat sat on the mat " * 30, "x y z " * 9000]
    for text in texts:
        assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) % 2**64 == by_hand(text)


def test_links_are_all_pairs_within_the_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)] + [0, 2**64 - 1, 1 << 63]
    found = set(base)
    for b in base:
        for _ in range(25):
            for _ in range(rng.randint(1, 4)):
                b ^= 1 << rng.randrange(64)
            found.add(b)
    signed = [f - 2**64 if f >> 63 else f for f in found]
    points = spark.createDataFrame([(f,) for f in signed], "f long")
    for radius in (1, 2):
        want = {tuple(sorted((a, b))) for a in signed for b in signed if a != b and ((a ^ b) % 2**64).bit_count() <= radius}
        got = [tuple(r) for r in simhash.links(points, radius).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components(spark):
    rng = random.Random(1)
    linked = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    linked += [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(90)]
    got = {r.node: r.root for r in components(spark.createDataFrame(linked, "a long, b long")).collect()}
    want = roots({i for p in linked for i in p}, linked)
    alone = {i for i in want if list(want.values()).count(want[i]) == 1}
    assert set(got) == set(want) - alone
    for i in got:
        for j in random.Random(i).sample(sorted(got), 20):
            assert (got[i] == got[j]) == (want[i] == want[j])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    f = {i: by_hand(t) for i, t in zip(docs.doc_id, docs.text)}
    ids = sorted(f)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k:] if (f[a] ^ f[b]).bit_count() <= 2]
    want = roots(ids, linked)
    got = simhash.groups(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f[i]:016x}", want[i]) for i in ids}
    assert len(got) == len(ids)


def test_rows(spark):
    rows = [(5, None, 1), (3, "", 1), (3, "", 1), (9, "a b c", 1), (None, "a b c", 1), (None, "other words here now", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f int")
    got = sorted(((r.doc_id, r.fingerprint == "0" * 16, r.component_id) for r in simhash.groups(docs).collect()), key=repr)
    assert got == sorted([(5, True, 3), (3, True, 3), (3, True, 3), (9, False, 9), (None, False, 9), (None, False, None)], key=repr)
    assert simhash.groups(docs.limit(0)).count() == 0


def kept_by_hand(rows, width=3, radius=2):
    """Ids that stay of (id, text): of each component the least."""
    f = {i: by_hand(t, width) for i, t in rows}
    ids = sorted(f)
    return set(roots(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k:] if (f[a] ^ f[b]).bit_count() <= radius]).values())


def test_keep_one(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 400, 4000]))]
        for _ in range(rng.choice([1, 2, 15])):
            words = list(base)
            words[rng.randrange(len(words))] = "new"
            rows.append((len(rows), rng.choice([" ", "\n"]).join(words)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two")]
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, hash long")
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == kept_by_hand(rows)
    assert len(kept_by_hand(rows)) < len(rows) - 10
    extra = spark.createDataFrame([(None, "one", 1), (903, "one", 1), (903, "one", 2)], "doc_id long, text string, hash long")
    both = [r.doc_id for r in simhash.keep_one(docs.unionByName(extra)).where("text = 'one'").collect()]
    assert both == [903, 903, 903]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_keep_one_without_ids_and_of_repeated_ids(spark):
    rows = [(None, "x y z u"), (None, "X y z u"), (None, "something else is here"), (3, "a b c d"), (3, "e f g h"), (1, "e f g h"), (None, "a b c d")]
    got = sorted((repr(r.doc_id), r.text.lower()) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("None", "x y z u"), ("None", "something else is here"), ("3", "a b c d"), ("1", "e f g h")])


def test_pairs_that_meet_grow_with_the_rows(spark):
    rng = random.Random(6)
    numbers = [rng.getrandbits(64) - 2**63 for _ in range(20_000)]
    points = spark.createDataFrame([(f,) for f in numbers], "f long")
    assert simhash.met(points, 2).where("f <> g").count() < 2_000
