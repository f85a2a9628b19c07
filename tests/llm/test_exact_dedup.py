import hashlib
import random

from propensity.llm import exact_dedup as ed


def by_hand(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\v\f\r"), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        body = "".join(c for c in t or "" if c not in " \t\n\v\f\r")
        keep = min(groups[body])[1]
        out.append((i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out)


def test_cuts_depend_on_content():
    rng = random.Random(1)
    raw = bytes(rng.randrange(256) for _ in range(60_000))
    ends = ed.cuts(raw)
    assert ends[-1] == len(raw) and all(ed.LEAST <= b - a <= ed.MOST for a, b in zip([0, *ends], ends[:-1]))
    shifted = ed.cuts(b"x" * 300 + raw)
    assert len({e - 300 for e in shifted} & set(ends)) > 0.8 * len(ends)
    assert ed.cuts(b"") == [] and ed.cuts(b"ab") == [2]
    assert max(b - a for a, b in zip([0, *ed.cuts(b"a" * 50_000)], ed.cuts(b"a" * 50_000))) <= ed.MOST


def test_groups(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh \n") for _ in range(30_000))
    texts = [None, "", " \n", "a b", "ab", "a  b", "a\xa0b", long, long.replace(" ", "  "), long[:-1] + "z", "z" + long[1:],
             "é", "é", "ab"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, recipe string, short int")
    for bits in (64, 3):  # three bits: many chunks share a short identifier
        got = sorted(tuple(r) for r in ed.groups(docs, bits=bits).collect())
        assert got == by_hand(rows)
    kept = {r[0] for r in by_hand(rows) if r[3]}
    left = ed.keep_first(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, "b")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in ed.groups(docs).collect()), key=repr)
    assert got == [(1, None, 3, False), (1, None, 3, False), (2, 2, 1, True), (None, None, 3, True)]
    assert ed.groups(docs.limit(0)).count() == 0 and ed.keep_first(docs.limit(0)).count() == 0


def test_keep_first_drops_rows_not_ids(spark):
    rows = [(None, "abc"), (1, "a b c"), (None, "only here"), (3, "abcd "), (5, "abcd"), (5, "another text"),
            (6, None), (7, ""), (7, "\u00e9\x0b x"), (8, "\u00e9x\xa0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(map(tuple, ed.keep_first(docs).collect()), key=repr)
    assert left == sorted([r for r in rows if r not in ((None, "abc"), (5, "abcd"), (7, ""))], key=repr)


def test_whole_table(same_as_sql):
    same_as_sql("op5_exact_dedup")
