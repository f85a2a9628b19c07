import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from propensity.llm import divergence
from propensity.llm.queries import QUERIES
from propensity.llm.transducer import Transducer

SCHEMA = "doc_id long, text string, lang string, source string"


def by_hand(rows, least=3, top=200):
    """(lang, source, part, item, value, rank) of rows (text, lang, source)."""
    docs = [(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), g or "", s or "")
            for t, g, s in rows]
    out = set()
    for lang in {g for _, g, _ in docs}:
        stands, count = Counter(), defaultdict(Counter)
        for terms, g, s in docs:
            if g == lang:
                stands.update(set(terms))
                count[s].update(terms)
        kept = sorted(t for t, n in stands.items() if n >= least)
        whole = sum(count.values(), Counter())

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        share, q = {s: p(c) for s, c in count.items()}, p(whole)

        def ranked(s, part, pairs):
            pairs = sorted(pairs, key=lambda x: (-x[1], x[0].encode()))
            return {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(pairs)}
        for s in count:
            out |= ranked(s, "pair", [(o, sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept)) for o in count if o != s])
            terms = [(t, (share[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[s][t] and share[s][t] > q[t]]
            out |= {r for r in ranked(s, "term", terms) if r[-1] <= top}
    return out


def result(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_sql(same_as_sql):
    same_as_sql("op13_divergence")


def corpus(seed, n=220):
    rng = random.Random(seed)
    words = ["Ab", "ab", "abc", "éa", "É", "z", "zz", "𝄞", "￿", "the", "The", "a1b", "x_y", "\x00q", "ünder", "日本"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    return [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None, ""]),
             rng.choice(["a", "b", "é", "", None, "￿", "𝄞"])) for _ in range(n)]


def given(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).selectExpr("*", "1 AS n", "2 AS ordinal", "'x' AS term")


def test_odd_rows(spark):
    rows = corpus(1) + [(None, "en", "silent"), ("", "none", None), ("one two", "few", "a"), ("one", "few", "b"), ("w" * 300_000, "en", "a")]
    rows += [("ties ties", "tie", s) for s in "abcabc"]
    assert result(divergence.audit(given(spark, rows))) == by_hand(rows)
    assert result(divergence.audit(given(spark, rows), least=1, top=2)) == by_hand(rows, 1, 2)
    empty = given(spark, rows).limit(0)
    assert divergence.audit(empty).count() == 0


def test_many_transducers_and_blocks(spark, monkeypatch):
    rows = corpus(2)
    want = by_hand(rows)
    monkeypatch.setattr(divergence, "PIECE", 7)
    monkeypatch.setattr(divergence, "BLOCK", 2000)
    monkeypatch.setattr(divergence, "FLUSH", 50)
    monkeypatch.setattr(divergence, "CHUNK", 64)
    assert result(divergence.audit(given(spark, rows))) == want


def test_transducer():
    rng = random.Random(5)
    terms = sorted({bytes(rng.choice(b"abc\xff") for _ in range(rng.randint(1, 7))) for _ in range(900)})
    made = Transducer.unpack(Transducer.build(terms).pack())
    others = [bytes(rng.choice(b"abcd\xff") for _ in range(rng.randint(1, 9))) for _ in range(900)]
    asked = terms + others
    text = np.frombuffer(b" ".join(asked), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in asked]) - 1
    starts = ends - [len(t) for t in asked]
    place = {t: i for i, t in enumerate(terms)}
    assert made.ordinals(text, starts, ends).tolist() == [place.get(t, -1) for t in asked]
    with pytest.raises(ValueError):
        Transducer.build([b"b", b"a"])
    assert Transducer.build([]).ordinals(text, starts, ends).tolist() == [-1] * len(asked)


def test_transducer_is_minimal():
    # No two states accept the same endings.
    terms = sorted(f"{a}{b}{c}".encode() for a in "xyz" for b in ("", "k", "mm") for c in ("ing", "ed", "s"))
    made = Transducer.build(terms)
    endings = {}
    for state in range(len(made.final)):
        def walk(s):
            out = {b""} if made.final[s] else set()
            for key, to in zip(made.key, made.target):
                if key >> 8 == s:
                    out |= {bytes([key & 255]) + rest for rest in walk(to)}
            return out
        endings[frozenset(walk(state))] = state
    assert len(endings) == len(made.final)
    assert frozenset(terms) in endings


def test_lots_number_each_term_once():
    rng = random.Random(9)
    texts = [t or "" for t, _, _ in corpus(8, 60)] + ["", "   ", "x" * 300, " a  b\n", "\x00\t9"]
    rng.shuffle(texts)
    want = [re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    for limit in (1, 200, 1 << 20):
        for given_texts in (pa.chunked_array([texts[:20], texts[20:]]), pa.chunked_array([pa.array(["ab", *texts])[1:]])):
            got, lots = [[] for _ in texts], 0
            for first, terms, codes, owner in divergence._terms(given_texts, limit):
                terms, lots = terms.to_pylist(), lots + 1
                assert len(set(terms)) == len(terms)
                for c, o in zip(codes.tolist(), owner.tolist()):
                    got[first + o].append(terms[c])
            assert got == want and lots == {1: len(texts), 1 << 20: 1}.get(limit, lots)
    assert not list(divergence._terms(pa.chunked_array([], pa.string()), 10))
