"""Trees on blocks of binned rows against MLlib's own; random numbers against Spark's; models queries at one scan a level."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from propensity.catalog import models
from propensity.operators import boost, draws, model
from propensity.session import stored


@pytest.fixture(autouse=True)
def blocks_at_any_size(monkeypatch):
    monkeypatch.setattr(boost, "LEAST_ROWS", 0)


def rows_of(spark, n, gaps):
    """Two numbers, one with gaps where asked, a category, and an outcome that follows them; folds 0 to 2."""
    df = spark.range(n).select("id", (F.xxhash64("id") % 1000 / 10).alias("a"), (F.xxhash64("id", F.lit(1)) % 7).alias("b"),
                               F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5)).cast("string").alias("c"), (F.col("id") % 3).cast("int").alias("fold"))
    pull = F.col("a") / 50 + F.col("b") / 3 + F.when(F.col("c") == "2", 1.5).otherwise(0) + F.xxhash64("id", F.lit(3)) % 100 / 60
    df = df.withColumn("y", (pull > 0.3).cast("int"))
    return stored(df.withColumn("a", F.when(F.col("id") % 6 != 0, F.col("a"))) if gaps else df, "rows")


def plain(trees):
    return [line.strip() for line in trees.toDebugString.split("\n")[1:]]


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if x != y:  # the last digit of a sum
            assert x.split(": ")[0] == y.split(": ")[0] == "Predict"
            assert float(x.split(": ")[1]) == pytest.approx(float(y.split(": ")[1]), rel=1e-12)


@pytest.mark.parametrize("gaps", [False, True])
@pytest.mark.parametrize("encoder", ["codes", "onehot"])
@pytest.mark.parametrize("tolerance", [None, 0.02])
def test_trees_are_those_of_mllib(spark, monkeypatch, gaps, encoder, tolerance):
    monkeypatch.setattr(boost, "BLOCK", 500)
    data = model.encode_frames(rows_of(spark, 4000, gaps), None, "id", "y", "fold", ["a", "b", "c"], ["c"], encoder)
    params = model.merge_params({"num_boost_round": 4, "num_leaves": 8, "min_data_in_leaf": 20, "learning_rate": 0.5, "feature_fraction": 0.6})
    found = model.parts(model.fit_fold(data, 1, params, early_stopping=tolerance))[1]
    filling = data.filling(1)
    rows = PipelineModel(filling).transform(data.train) if filling else data.train
    rows = rows.where("fold <> 1") if tolerance is None else rows.withColumn("_held", F.col("fold") == 1)
    want = model.make_gbt(params, data.max_bins, tolerance).fit(rows)
    same(plain(found), plain(want))
    assert found.getNumTrees == want.getNumTrees and found.treeWeights == want.treeWeights
    scored = model.probability(rows, found, "p").select("id", "p").join(model.probability(rows, want, "q").select("id", "q"), "id")
    assert scored.where("abs(p - q) > 1e-12").isEmpty()


def test_counts_added_in_tasks_give_the_same_trees(spark, monkeypatch):
    data = model.encode_frames(rows_of(spark, 3000, True), None, "id", "y", "fold", ["a", "b", "c"], ["c"])
    params = model.merge_params({"num_boost_round": 2, "num_leaves": 8, "min_data_in_leaf": 10})
    one = model.parts(model.fit_fold(data, 0, params))[1]
    monkeypatch.setattr(boost, "DRIVER_BYTES", 0)
    monkeypatch.setattr(boost, "GROUP_BYTES", 1)  # and a node at a time, with other columns drawn for it
    assert plain(model.parts(model.fit_fold(data, 0, {**params, "feature_fraction": 1.0}))[1])
    monkeypatch.setattr(boost, "GROUP_BYTES", 256 << 20)
    same(plain(model.parts(model.fit_fold(data, 0, params))[1]), plain(one))


def test_rows_are_binned_once_for_all_settings(spark, monkeypatch):
    made, real = [], boost.bin_rows
    monkeypatch.setattr(boost, "bin_rows", lambda *a: made.append(1) or real(*a))
    data = model.encode_frames(rows_of(spark, 600, False), None, "id", "y", "fold", ["a", "b", "c"], ["c"])
    for leaves in (2, 4):
        model.fit_encoded(data, {"num_boost_round": 1, "num_leaves": leaves, "min_data_in_leaf": 5})
    assert len(made) == 3


def test_small_tables_have_the_same_trees_from_mllib(spark, monkeypatch):
    data = model.encode_frames(rows_of(spark, 1500, True), None, "id", "y", "fold", ["a", "b", "c"], ["c"])
    params = model.merge_params({"num_boost_round": 2, "num_leaves": 4, "min_data_in_leaf": 10})
    one = plain(model.parts(model.fit_fold(data, 0, params))[1])
    monkeypatch.setattr(boost, "LEAST_ROWS", 1500)
    monkeypatch.setattr(boost, "fit_trees", None)
    same(plain(model.parts(model.fit_fold(data, 0, params))[1]), one)


def test_labels_and_numbers_that_do_not_fit_are_refused(spark):
    df = rows_of(spark, 300, False).withColumn("y", F.col("y") + 1)
    data = model.encode_frames(df, None, "id", "y", "fold", ["a", "b"])
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        model.fit_fold(data, 0, model.merge_params({"num_boost_round": 1}))


def test_random_numbers_are_spark_s(spark):
    of = spark._jvm.org.apache.spark.util.random.XORShiftRandom
    for seed in (0, 42, -5, 2 ** 40 + 7):
        register = of(seed)
        want = [register.nextDouble() for _ in range(200)]
        assert np.array_equal(draws.doubles(seed, 0, 200), want) and np.array_equal(draws.doubles(seed, 150, 50), want[150:])
        assert of(seed).nextInt() == draws.Register(seed).integer()
    whole = draws.doubles(7, 0, 70_000)
    assert np.array_equal(whole[32_768:65_536], draws.doubles(7, 32_768, 32_768))


def test_folded_rows_are_read_from_a_table(spark, folder):
    train, _ = models.planted_splits(spark, folder)
    assert train.inputFiles() and "Window" not in train._jdf.queryExecution().executedPlan().toString()
