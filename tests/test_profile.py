import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.operators import profile, rates


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(5)
    n = 500
    return pd.DataFrame({
        "id": range(n), "a": rng.normal(size=n), "b": rng.integers(-20, 20, n).astype(float),
        "g": rng.choice(["x", "y", "z", None], n), "h": rng.choice(["p", "q"], n), "w": rng.choice(["k", "l", "m"], n),
        "y": rng.integers(0, 2, n), "p": rng.random(n).round(3)})


@pytest.fixture(scope="module")
def sdf(spark, pdf):
    rows = [tuple(None if v is None else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, a double, b double, g string, h string, w string, y int, p double")


def test_describe_equals_pandas(sdf, pdf, tiny_tasks):
    got = profile.describe(sdf, ["a", "b"]).toPandas().set_index("column")
    want = pdf[["a", "b"]].describe().T
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                         ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        np.testing.assert_allclose(got.loc[["a", "b"], ours].astype(float), want[theirs], atol=1e-9)


def test_missing_counts_see_null_and_nan(spark):
    df = spark.createDataFrame([(1, math.nan, None), (2, None, "x"), (3, 0.5, "y")], "i int, d double, s string")
    got = {r["column"]: r["missing"] for r in profile.missing_counts(df).collect()}
    assert got == {"i": 0, "d": 2, "s": 1, "(total)": 3}


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a"), (3, 1, "a"), (4, 1, "a"), (5, 1, "a")], "id int, n int, s string")
    assert profile.duplicate_rows(df, ["id"]).first()[0] == 3
    assert profile.duplicate_rows(df).first()[0] == 0


def test_unique(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "i int")
    assert profile.is_unique(df, "i").first()["unique"]
    assert not profile.is_unique(df.union(df), "i").first()["unique"]


def test_value_counts_leave_out_null(sdf, pdf):
    got = {r["g"]: (r["count"], r["share"]) for r in profile.value_counts(sdf, "g").collect()}
    counts, shares = pdf.g.value_counts(), pdf.g.value_counts(normalize=True)
    assert got == {k: (counts[k], pytest.approx(shares[k])) for k in counts.index}


def test_level_consistency(spark):
    a = spark.createDataFrame([("u", "m"), ("v", "m")], "c string, d string")
    b = spark.createDataFrame([("u", "m"), ("w", "m"), ("z", "m")], "c string, d string")
    got = {r["column"]: (r["levels"], r["train_only"], r["test_only"], r["same"])
           for r in profile.level_consistency(a, b, ["c", "d"]).collect()}
    assert got == {"c": (4, 1, 2, False), "d": (1, 0, 0, True)}


def test_histogram_equals_numpy(sdf, pdf):
    got = profile.histogram(sdf, "a", 12).toPandas().sort_values("bin").set_index("bin")
    counts, marks = np.histogram(pdf.a, 12)
    density, _ = np.histogram(pdf.a, 12, density=True)
    np.testing.assert_array_equal(got["count"].reindex(range(12)).fillna(0), counts)
    np.testing.assert_allclose(got["density"], density[got.index])
    np.testing.assert_allclose(got["lo"], marks[got.index], atol=1e-12)


def test_histogram_of_one_value(spark):
    row = profile.histogram(spark.range(9).select(F.lit(2.0).alias("v")), "v", 4).collect()
    assert len(row) == 1 and row[0]["count"] == 9 and row[0]["bin"] == 2


def test_corr_equals_pandas_pairwise(spark):
    rows = [(1.0, 2.0, None), (2.0, None, 1.0), (3.0, 5.0, 2.0), (4.0, 4.0, 2.5), (5.0, 9.0, 1.0)]
    got = profile.corr_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    want = pd.DataFrame(rows, columns=list("abc")).corr()
    for r in got.collect():
        assert r["corr"] == pytest.approx(want.loc[r["a"], r["b"]])


def test_class_means_of_zero_mean_has_no_percentage(spark):
    df = spark.createDataFrame([("No", 0.0), ("Yes", 2.0)], "t string, v double")
    assert profile.class_means(df, ["v"], "t").first()["diff_pct"] is None


def test_smoothed_rate(sdf, pdf):
    got = {r["g"]: r["smoothed_rate"] for r in rates.smoothed_rate(sdf, ["g"], "y", 10).collect()}
    assert set(got) == {"x", "y", "z"}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx((part.y.sum() + 10 * pdf.y.mean()) / (len(part) + 10))


def pandas_spread(pdf, keys, minimum):
    stats = pdf.groupby(keys)["y"].agg(["mean", "count"])
    return stats[stats["count"] >= minimum]


def test_pairs_leave_out_null_levels(sdf, pdf):
    got = {(r["feature_1"], r["feature_2"]): r for r in rates.pair_interactions(sdf, ["g", "h", "w"], "y", 20).collect()}
    for a, b in (("g", "h"), ("g", "w"), ("h", "w")):
        want = pandas_spread(pdf, [a, b], 20)
        r = got[(a, b)]
        assert r["n_combinations"] == len(want)
        assert r["rate_range"] == pytest.approx(want["mean"].max() - want["mean"].min())
        spread = np.average(np.abs(want["mean"] - pdf.y.mean()), weights=want["count"])
        assert r["weighted_std"] == pytest.approx(spread)


def test_pairs_without_a_large_group_are_left_out(sdf):
    assert rates.pair_interactions(sdf, ["g", "h"], "y", 10_000).count() == 0


@pytest.mark.parametrize("most", [1, 6, 1000])
def test_subsets_in_several_blocks(sdf, pdf, monkeypatch, most):
    cols = ["g", "h", "w", "y"]
    whole = [sorted(map(tuple, f(sdf, cols, "y", 5).collect())) for f in (rates.pair_interactions, rates.triple_interactions)]
    monkeypatch.setattr(rates, "FEW", 0)
    monkeypatch.setattr(rates, "MOST_GROUPS", most)
    got = {r["features"]: r["n_combinations"] for r in rates.combo_frequencies(sdf, ["g", "h", "w"]).collect()}
    assert got == {"g × h": 6, "g × w": 9, "h × w": 6}
    blocks = [sorted(map(tuple, f(sdf, cols, "y", 5).collect())) for f in (rates.pair_interactions, rates.triple_interactions)]
    for a, b in zip(whole, blocks):
        assert len(a) == len(b)
        for x, z in zip(a, b):
            assert x == pytest.approx(z)


def test_blocks_hold_every_subset():
    sizes = {f"c{i}": 2 + i % 5 for i in range(40)}
    pairs = list(itertools.combinations(sizes, 2))
    blocks = rates.column_blocks(pairs, sizes, 100_000)
    assert all(any(set(p) <= set(b) for b in blocks) for p in pairs) and len(blocks) < len(pairs) / 4
    assert all(math.prod(sizes[c] for c in b) <= 100_000 for b in blocks)
    assert rates.column_blocks([("a", "b"), ("a", "c")], {"a": 10, "b": 10, "c": 10}, 50) == [("a", "b"), ("a", "c")]


def test_forty_columns_in_one_query(spark):
    df = spark.range(300).select(F.pmod("id", F.lit(2)).alias("y"), *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(3)).alias(f"c{i}") for i in range(40)])
    got = rates.pair_interactions(df, [f"c{i}" for i in range(40)], "y", 1).collect()
    assert len(got) == 780 and {r["n_combinations"] for r in got} == {9}


def test_grid_of_bins_and_levels(sdf, pdf, tiny_tasks):
    got = {(r["numerical"], r["categorical"]): r["rate_range"]
           for r in rates.numeric_cat_interactions(sdf, ["a", "b"], ["g", "h"], "y", 4, 5).collect()}
    for num in ("a", "b"):
        for cat in ("g", "h"):
            binned = pdf.assign(bin=pd.qcut(pdf[num], 4, duplicates="drop", labels=False))
            want = pandas_spread(binned, ["bin", cat], 5)["mean"]
            assert got[(num, cat)] == pytest.approx(want.max() - want.min())


def test_modulo_audit_equals_pandas(sdf, pdf):
    got = {(r["feature"], r["operation"]): r for r in rates.modulo_audit(sdf, ["id", "b"], [2, 3, 10], "y", 10).collect()}
    for col in ("id", "b"):
        for m in (2, 3, 10):
            stats = pdf.assign(v=pdf[col] % m).groupby("v")["y"].agg(["mean", "count"])
            stats = stats[stats["count"] >= 10]
            r = got[(col, f"mod_{m}")]
            assert r["n_groups"] == len(stats)
            assert r["max_deviation"] == pytest.approx((stats["mean"] - pdf.y.mean()).abs().max())
            assert r["weighted_rate"] == pytest.approx(np.average(stats["mean"], weights=stats["count"]))


def test_modulo_residuals_equal_pandas(sdf, pdf):
    got = {(r["feature"], r["mod"]): r["max_abs_mean_residual"]
           for r in rates.modulo_residual_audit(sdf, ["b"], [3, 5], "y", "p").collect()}
    for m in (3, 5):
        want = (pdf.y - pdf.p).groupby(pdf.b % m).mean().abs().max()
        assert got[("b", m)] == pytest.approx(want)


def test_reports_keep_struct_columns_readable(spark, sdf, tmp_path):
    from propensity.operators.order import quantile_bin
    from propensity.sources.files import write_report

    path = write_report(quantile_bin(sdf, "a", 4).select("id", "a_bin"), str(tmp_path / "deep" / "report"))
    assert spark.read.option("header", True).csv(path).columns == ["id", "a_bin_bin", "a_bin_lo", "a_bin_hi"]


@pytest.mark.parametrize("block", [3, 4096])
def test_corr_in_blocks_with_gaps_and_constants(spark, monkeypatch, block):
    monkeypatch.setattr(profile, "BLOCK", block)
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"a": 1e9 + rng.normal(size=300), "b": rng.normal(size=300), "c": 0.1, "d": np.nan, "e": rng.integers(0, 3, 300).astype(float)})
    frame["f"] = frame.a * 2 - frame.b
    frame.loc[::3, "b"] = np.nan
    frame.loc[1::3, "e"] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame)).repartition(7)
    want = frame.corr()
    got = profile.corr_matrix(df, list(frame)).collect()
    assert len(got) == 36
    for r in got:
        w = want.loc[r["a"], r["b"]]
        assert r["corr"] is None if np.isnan(w) or "c" in (r["a"], r["b"]) else r["corr"] == pytest.approx(w, abs=1e-7)


def test_two_hundred_columns(spark):
    df = spark.range(400).select(*[F.rand(i).alias(f"c{i}") for i in range(200)])
    got = profile.corr_matrix(df, df.columns)
    assert got.count() == 40_000 and got.where("a = b and abs(corr - 1) > 1e-9").count() == 0
