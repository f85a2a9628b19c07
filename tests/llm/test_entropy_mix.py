import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pandas as pd
import pytest

from propensity.llm import entropy_mix
from propensity.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string"


def words(text):
    return len(re.findall("[^\x20\x09-\x0D]+", text or ""))


def targets_by_hand(sizes, share=Fraction(3, 2), weights=(3, 1, 2), most=2):
    """Source -> target, as a fraction; ``sizes``: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = share * sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in order if s not in full)
        level = (left - sum(most * sizes[s] for s in full)) / rest if rest else Fraction(0)
        above = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not above:
            return {s: Fraction(most * sizes[s]) if s in full else level * weight[s] for s in order}
        full |= above


def tilt_by_hand(sizes, target, most=2):
    """Bisection for a in sum of z min(most, exp(a z)) = target."""
    lo, hi = -1.0, 1.0
    while sum(z * min(most, math.exp(lo * z)) for z in sizes) > target:
        lo *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(z * min(most, math.exp(min(mid * z, 50))) for z in sizes) < target else (lo, mid)
    return lo


def check(given, got):
    """Sizes, targets and rates by hand; taken words near their target."""
    by_source, of = defaultdict(list), {}
    for i, text, source in given:
        by_source[source].append(words(text))
        of[i] = source
    want = targets_by_hand({s: sum(z) for s, z in by_source.items()})
    size = {i: words(t) for i, t, _ in given}
    taken = defaultdict(int)
    assert len(got) == len(given)
    for r in got:
        source = of[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sum(by_source[source]))
        assert r.target == pytest.approx(float(want[source]), rel=1e-12)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[source] += r.taken
    for source, sizes in by_source.items():
        full = want[source] == 2 * sum(sizes)
        a = None if full or not sum(sizes) else tilt_by_hand([z for z in sizes if z], float(want[source]))
        for r in (r for r in got if of[r.doc_id] == source):
            assert r.rate == (0 if not r.size else 2 if a is None else pytest.approx(min(2, math.exp(a * r.size)), rel=1e-6))
        if full:
            assert taken[source] == want[source]
    return {s: (taken[s], float(want[s]), [z for z in by_source[s] if z]) for s in by_source}


def test_whole_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = QUERIES["op11_entropy_mix"](spark, SF).collect()
    for taken, target, _ in check(list(zip(docs.doc_id.tolist(), docs.text, docs.source)), got).values():
        assert abs(taken - target) <= max(20, 0.002 * target)
    again = QUERIES["op11_entropy_mix"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_hot_and_odd_sources(spark):
    rng = random.Random(2)
    rows = [(i, "w " * 7, "hot") for i in range(4000)]
    rows += [(5000 + i, "x\t" * rng.randint(1, 90), rng.choice(["b", "", "é", "𝄞", "￿", None])) for i in range(900)]
    rows += [(7000, None, "empty"), (7001, " \n", "empty"), (7002, "long " * 40_000, "one"), (7003, "a", "two"), (7004, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS copies", "3 AS n")
    for taken, target, sizes in check(rows, entropy_mix.mix(docs).collect()).values():
        assert abs(taken - target) <= (min(sizes) / 2 + 1e-6 if sizes else 0)


def test_shelves_split_a_hot_cell(spark, monkeypatch):
    rows = [(i, "w " * (7 + i % 2), "hot" if i % 3 else "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = {tuple(r)[:4] for r in entropy_mix.mix(docs).collect()}
    monkeypatch.setattr(entropy_mix, "DEALT", 50)
    got = entropy_mix.mix(docs).collect()
    assert {tuple(r)[:4] for r in got} == whole
    for taken, target, sizes in check(rows, got).values():
        assert abs(taken - target) <= min(sizes) / 2 + 1e-6


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, "a b", "s"), (None, "a b", "s"), (3, "a b", "s"), (3, "a b", "s"), (4, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = entropy_mix.mix(docs).collect()
    assert len(got) == 5 and sum(r.taken for r in got) == 12 and {r.target for r in got} == {12.0, 0.0}
    assert entropy_mix.mix(docs.limit(0)).count() == 0
    nothing = entropy_mix.mix(docs.where("text is null")).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)]


def test_targets_of_a_larger_share_stop_at_the_most(spark):
    rows = [(i, "w " * (i + 1), "ab"[i % 2]) for i in range(6)]
    got = entropy_mix.mix(spark.createDataFrame(rows, SCHEMA), share=Fraction(5, 1)).collect()
    assert all(r.taken == 2 * r.size for r in got)
