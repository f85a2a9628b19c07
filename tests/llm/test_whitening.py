import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from propensity.llm import whitening
from propensity.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>"


def by_hand(pairs, most=16):
    """(id, deviation, signless coordinates), eigenvalue shares and n, in exact sums and by a plain eigensolver."""
    good = [(i, v) for i, v in pairs if v is not None and len(v) and all(e is not None and math.isfinite(e) for e in v)]
    xs = [(i, tuple(math.floor(64 * float(e)) + 1_000_000 for e in v)) for i, v in good]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    totals = [sum(x[k] for x in fit) for k in range(d)]
    y = np.array([[float(Fraction(n * e - t, n)) for e, t in zip(x, totals)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    axes = vectors[:, :k] / np.sqrt(values[:k])
    rows = [(i, sum((n * e - t) ** 2 for e, t in zip(x, totals)),
             np.array([float(Fraction(n * e - t, n)) for e, t in zip(x, totals)]) @ axes) for i, x in xs]
    return rows, values[:k] / values.sum(), n


def check(pairs, got, most=16):
    rows, shares, n = by_hand(pairs, most)
    table = {}
    for r in got:
        table.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(rows) * len(shares) and set(table) == {i for i, _, _ in rows}
    signs = np.zeros(len(shares))
    for i, deviation, w in rows:
        mine = [table[i][c + 1] for c in range(len(shares))]
        assert {(r.n, r.deviation) for r in mine} == {(n, deviation)}
        assert [r.explained for r in mine] == pytest.approx(shares.tolist(), rel=1e-9)
        ours = np.array([r.whitened for r in mine])
        signs = np.where((signs == 0) & (np.abs(w) > 1e-3), np.sign(ours * w), signs)
        assert ours * np.where(signs == 0, 1, signs) == pytest.approx(w, abs=1e-8) or (signs == 0).any()
        assert all(r.identity_error < 1e-9 for r in mine)


def test_whole_table(spark):
    frame = pd.read_parquet(f"{SF}/embeddings.parquet")
    check(list(zip(frame.vec_id.tolist(), frame.embedding)), QUERIES["op12_whitening"](spark, SF).collect())


def test_copies_nulls_and_few_dimensions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(a), float(a * 2 + b), float(b - 1)]) for i, (a, b) in enumerate(rng.normal(size=(60, 2)))]
    rows += [(100 + i, rows[0][1]) for i in range(500)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, math.nan, 2.0]), (904, [math.inf, 0.0, 0.0]), (905, [1.0, 2.0])]
    docs = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS x", "2 AS id", "3 AS n")
    got = whitening.whiten(docs).collect()
    check(rows, got)
    assert max(r.component for r in got) == 3  # floor leaves a little in the third direction


def test_no_rows_one_row_and_null_ids(spark):
    docs = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])], SCHEMA)
    assert whitening.whiten(docs).count() == 0 and whitening.whiten(docs.limit(0)).count() == 0
    more = docs.union(spark.createDataFrame([(None, [3.0, 2.0])], SCHEMA))
    got = whitening.whiten(more).collect()
    assert len(got) == 4 and {abs(r.whitened) for r in got} == {1.0} and {r.deviation for r in got} == {128 ** 2}


def test_deviation_beyond_64_bits_fails(spark):
    docs = spark.createDataFrame([(1, [1e10]), (2, [-1e10])], SCHEMA)
    with pytest.raises(Exception):
        whitening.whiten(docs).collect()


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (5, 5), (9, 4), (40, 40), (33, 12)):
        a = rng.normal(size=(d, rank)) * np.logspace(0, -6, rank)
        v = a @ a.T
        g = whitening.pivoted_cholesky(v)
        assert g @ g.T == pytest.approx(v, abs=1e-13 * np.trace(v))
        values, vectors = whitening.jacobi(g)
        want = np.sort(np.linalg.eigvalsh(v))[::-1]
        assert values[:rank] == pytest.approx(want[:len(values)][:rank], rel=1e-7, abs=1e-15 * want[0])
        assert vectors.T @ vectors == pytest.approx(np.eye(len(values)), abs=1e-7)
    graded = np.diag([1.0, 1e-8, 1e-14]) + np.array([[0, 1e-6, 1e-9], [1e-6, 0, 1e-13], [1e-9, 1e-13, 0]])
    assert whitening.pivoted_cholesky(np.zeros((4, 4))).shape == (4, 0)
    assert whitening.jacobi(whitening.pivoted_cholesky(graded))[0][0] == pytest.approx(1.0)
