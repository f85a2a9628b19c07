import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.operators import order

KINDS = ["spread", "tied", "one_hot_value", "with_nulls", "negative"]


def values(kind, n=400):
    rng = random.Random(kind)
    if kind == "spread":
        return [rng.gauss(0, 1) for _ in range(n)]
    if kind == "tied":
        return [float(rng.randint(0, 6)) for _ in range(n)]
    if kind == "one_hot_value":  # one value holds more than a third of the rows
        return [0.5 if rng.random() < 0.4 else round(rng.random(), 3) for _ in range(n)]
    if kind == "with_nulls":
        return [None if rng.random() < 0.1 else rng.random() for _ in range(n)]
    return [rng.choice([-0.0, 0.0, -1.5, -2.0, 3.0, rng.uniform(-5, 5)]) for _ in range(n)]


def frame(spark, kind):
    return spark.createDataFrame(list(enumerate(values(kind))), "id long, x double").repartition(5)


@pytest.fixture(params=["few", "many"])
def ways(request):
    """Both the plan for few rows and the distributed one."""
    if request.param == "many":
        request.getfixturevalue("tiny_tasks")
    return request.param


@pytest.mark.parametrize("kind", KINDS)
def test_percentile_rank_equals_pandas(spark, kind, ways):
    got = order.percentile_rank(frame(spark, kind), "x", "id").toPandas().sort_values("id")["pct_rank"].to_numpy(dtype=float)
    want = pd.Series(values(kind), dtype=float).rank(method="average", pct=True).to_numpy()
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-12)


@pytest.mark.parametrize("kind", KINDS)
def test_quantiles_equal_numpy(spark, kind, ways):
    probs = [0, 0.1, 0.25, 0.333, 0.5, 0.9, 1]
    got = order.quantiles(frame(spark, kind), ["x", "id"], probs)
    known = [v for v in values(kind) if v is not None]
    np.testing.assert_allclose(got["x"], np.quantile(known, probs), atol=1e-12)
    np.testing.assert_allclose(got["id"], np.quantile(np.arange(400), probs), atol=1e-12)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("q", [4, 10])
def test_quantile_bin_equals_qcut(spark, kind, q, ways):
    got = order.quantile_bin(frame(spark, kind), "x", q).select("id", "x_bin.bin").toPandas().sort_values("id")["bin"]
    want = pd.qcut(pd.Series(values(kind), dtype=float), q, labels=False, duplicates="drop")
    np.testing.assert_array_equal(got.to_numpy(dtype=float), want.to_numpy(dtype=float))


def test_bins_hold_their_values(spark):
    out = order.quantile_bin(frame(spark, "spread"), "x", 7).select("x", "x_bin.*")
    outside = out.where((F.col("x") > F.col("hi") + 1e-9) | ((F.col("x") <= F.col("lo") - 1e-9)))
    assert outside.count() == 0


def test_constant_column_has_no_bins(spark, ways):
    df = spark.range(50).select("id", F.lit(3.0).alias("x"))
    assert order.quantile_bin(df, "x", 4).where("x_bin is not null").count() == 0


def test_empty_column_has_no_quantiles(spark, ways):
    df = spark.range(50).select("id", F.lit(None).cast("double").alias("x"))
    assert order.quantiles(df, ["x"], [0.5])["x"] in ([], [None])


@pytest.mark.parametrize("kind", ["spread", "tied", "one_hot_value"])
def test_ordered_cumsum_equals_pandas(spark, kind, ways):
    df = frame(spark, kind).withColumn("g", F.col("id") % 3).withColumn("one", F.lit(1))
    got = order.ordered_cumsum(df, "x", ["one", "id"], by=["g"]).toPandas().sort_values(["g", "x"]).reset_index(drop=True)
    src = pd.DataFrame({"id": range(400), "x": values(kind)})
    src["g"], src["one"] = src["id"] % 3, 1
    want = src.groupby(["g", "x"], as_index=False)[["one", "id"]].sum().sort_values(["g", "x"]).reset_index(drop=True)
    for c in ("one", "id"):
        np.testing.assert_array_equal(got[c], want[c])
        np.testing.assert_array_equal(got[f"cum_{c}"], want.groupby("g")[c].cumsum())


def test_descending_running_totals(spark, tiny_tasks):
    grouped = frame(spark, "tied").groupBy("x").agg(F.count("*").alias("n"))
    cuts = order.cut_points(frame(spark, "tied"), "x")
    assert cuts
    got = order.running_totals(grouped, "x", ["n"], cuts=cuts, descending=True).toPandas().sort_values("x", ascending=False)
    np.testing.assert_array_equal(got["cum_n"], got["n"].cumsum())


def test_heavy_value_gets_its_own_range(spark, tiny_tasks):
    df = frame(spark, "one_hot_value")
    cuts = order.cut_points(df, "x")
    sizes = order.with_bucket(df, "x", cuts).groupBy(order.BUCKET).agg(F.countDistinct("x").alias("d"), F.count("*").alias("n"))
    heaviest = sizes.orderBy(F.desc("n")).first()
    assert heaviest["d"] == 1


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 0.5)], "id long, x double")
    assert [r["id"] for r in order.top_k(df, "x", 2, "id").collect()] == [1, 3]
    assert [r["id"] for r in order.top_k(df, "x", 2, "id", ascending=True).collect()] == [2, 1]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_result_does_not_depend_on_partitions(spark, parts, tiny_tasks):
    df = frame(spark, "one_hot_value")
    base = sorted(map(tuple, order.percentile_rank(df, "x", "id").collect()))
    assert sorted(map(tuple, order.percentile_rank(df.repartition(parts), "x", "id").collect())) == base
