"""One plan at every size: many columns, classes and levels, whole numbers beyond doubles, texts and times in order."""

import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propensity.functions import columns as fx
from propensity.operators import align, encode, ensemble, folds, metrics, order, profile, rates
from propensity.operators.checks import ContractError
from propensity.sources import frames


def cuts_of(monkeypatch, rows):
    from propensity import scale

    monkeypatch.setattr(scale, "MOST_ROWS", rows)
    monkeypatch.setattr(scale, "LEAST_ROWS", rows)


def test_cuts_do_not_change_a_digit(spark, folder, monkeypatch):
    df = frames.orders_frame(spark, folder, ["id", "amount", "y", "score_a", "priority"]).cache()
    df = df.withColumn("at", F.timestamp_micros(F.col("amount").cast("long")))
    seen = []
    for rows in (10**9, 300, 40):
        cuts_of(monkeypatch, rows)
        seen.append((
            order.quantiles(df, ["amount", "score_a"], [i / 300 for i in range(301)]),
            sorted(map(tuple, order.percentile_rank(df, "priority", "id").select("id", "pct_rank").collect())),
            sorted(map(tuple, order.percentile_rank(df, "at", "id").select("id", "pct_rank").collect())),
            sorted(map(tuple, order.ordered_cumsum(df.withColumn("n", F.lit(1)), "priority", ["n", "id"]).collect())),
            metrics.roc_auc(df, "y", "score_a").collect(), profile.describe(df, ["amount"]).select("q25", "q50", "q75").collect()))
    assert seen[0] == seen[1] == seen[2]


def test_many_columns(spark, folder):
    base = frames.orders_frame(spark, folder, ["id", "y", "priority"])
    cols = [f"c{i}" for i in range(40)]
    df = base.select("y", *[(F.col("id") % (i + 2)).alias(c) for i, c in enumerate(cols)])
    made = rates.pair_interactions(df, cols, "y", 1)
    got = {(r.feature_1, r.feature_2): r for r in made.collect()}
    assert len(got) == 40 * 39 // 2
    pdf = df.toPandas()
    for a, b in (("c0", "c1"), ("c5", "c39")):
        want = pdf.groupby([a, b]).y.mean()
        assert (got[a, b].n_combinations, got[a, b].max_rate) == (len(want), pytest.approx(want.max()))


def test_whole_numbers_beyond_doubles(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 2 * i + 1, i % 2) for i in range(1000)], "k long, y int")
    got = rates.modulo_residuals(df.withColumn("p", F.lit(0.5)), ["k"], [2, 10], "y", "p").where("mod = 2").collect()
    assert [(r.value, r.n) for r in got] == [(1.0, 1000)]
    exact = df.select(F.col("k").cast("decimal(20,0)").alias("k")).select(fx.integral("k").alias("k"))
    assert {r.k for r in exact.collect()} == {big + 2 * i + 1 for i in range(1000)}


def test_many_classes_and_levels(spark, monkeypatch):
    cuts_of(monkeypatch, 500)
    df = spark.range(18_000).select("id", (F.col("id") % 6000).alias("c"), F.concat(F.lit("level"), F.col("id") % 3000).alias("t"))
    folded = folds.stratified_folds(df, "id", "c", 3)
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and folded.groupBy("c", "fold").count().where("count > 1").count() == 0
    held = folds.stratified_holdout(df, "id", "c", 0.34).where("holdout").groupBy("c").count()
    assert held.where("count <> 1").count() == 0 and held.count() == 6000
    vocab = {r.level: r.code for r in encode.build_vocab(df, df, ["t"]).collect()}
    assert vocab == {t: i for i, t in enumerate(sorted({f"level{k}" for k in range(3000)}))}


def test_models_that_do_not_align_are_refused(spark):
    good = spark.createDataFrame([(1, 0.1), (2, 0.2)], "id long, prediction double")
    for bad in ([(1, 0.1), (1, 0.2), (2, 0.3)], [(1, 0.1)], [(1, 0.1), (2, float("nan"))], [(1, 0.1), (2, None)], [(1, 0.1), (None, 0.2)]):
        other = spark.createDataFrame(bad, "id long, prediction double")
        with pytest.raises(ContractError):
            align.align_models({"a": good, "b": other}, "id")


def test_blend_of_ranks_grows_with_the_models(spark):
    rng = random.Random(1)
    rows = [(i, *(rng.random() for _ in range(4))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double")
    size = [len(ensemble.blend_rank(df, dict.fromkeys("abcd"[:n], 1.0), "id")._jdf.queryExecution().optimizedPlan().toString().split("\n"))
            for n in (1, 2, 4)]
    assert size[2] - size[1] <= 2 * (size[1] - size[0]) + 4


@pytest.mark.parametrize("row", [(None, 0.5), (1, None), (1, float("nan")), (1, float("inf")), (2, 0.5)])
def test_scores_and_labels_that_cannot_be_ranked_fail(spark, row):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), row], "y int, p double")
    for made in (metrics.roc_auc, metrics.average_precision):
        with pytest.raises(PySparkException):
            made(df, "y", "p").collect()


def test_texts_that_begin_alike_fall_into_even_ranges(spark, monkeypatch):
    cuts_of(monkeypatch, 1000)
    rng = random.Random(2)
    urls = [f"https://host.example/catalogue/items?page={rng.randrange(5000)}" for _ in range(20_000)]
    urls[:7000] = [urls[0]] * 7000
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(-1, None)], "id long, url string")
    cuts = order.cut_points(df, "url")
    sizes = order.with_bucket(df, "url", cuts).where("url is not null").groupBy(order.BUCKET).agg(
        F.count("*").alias("n"), F.countDistinct("url").alias("d")).collect()
    assert len(sizes) > 8 and max(r["n"] for r in sizes if r["d"] > 1) <= 3 * 20_000 / len(sizes)
    assert [r["d"] for r in sizes if r["n"] > 5000] == [1]
    ranks = pd.Series(urls).rank(pct=True).tolist()
    got = {r["id"]: r["pct_rank"] for r in order.percentile_rank(df, "url", "id").collect()}
    assert got.pop(-1) is None and all(got[i] == pytest.approx(ranks[i]) for i in range(20_000))


@pytest.mark.parametrize("n", [1, 15, 16, 17, 255, 256, 257, 700])
def test_search_among_texts(spark, n):
    rng = random.Random(n)
    cuts = sorted(rng.sample([f"k{i:04d}" for i in range(2000)], n))
    asked = [f"k{rng.randrange(2000):04d}" for _ in range(300)] + cuts[:3] + cuts[-3:] + ["", "z"]
    df = spark.createDataFrame([(t,) for t in asked], "t string")
    for r in order.with_bucket(df, "t", cuts).collect():
        assert r[order.BUCKET] == sum(c <= r["t"] for c in cuts)


def test_quantiles_where_the_sketch_misses(spark, monkeypatch):
    rng = random.Random(9)
    values = [rng.gauss(0, 1) for _ in range(500)]
    df = spark.createDataFrame([(v, abs(v)) for v in values], "x double, z double").cache()
    probs = [0.0, 0.2, 0.5, 0.99, 1.0]
    want = order.quantiles(df, ["x", "z"], probs)
    monkeypatch.setattr(order.F, "percentile_approx", lambda c, p, a: F.array(*[F.lit(0.1)] * len(p)))
    assert order.quantiles(df, ["x", "z"], probs) == want
    assert want["x"] == pytest.approx(pd.Series(values).quantile(probs).tolist())


def test_digits_follow_the_largest_class(spark, monkeypatch):
    assert [folds.digits_for(n) for n in (0, 100_000, 100_001, 1_600_001, 10**8, 10**12)] == [0, 0, 1, 2, 3, 6]
    df = spark.range(3000).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
    whole = sorted(map(tuple, folds.stratified_folds(df, "id", "y").collect()))
    monkeypatch.setattr(folds, "BUCKET_ROWS", 5)
    assert sorted(map(tuple, folds.stratified_folds(df, "id", "y").collect())) == whole


def test_wide_one_hot_equals_the_dense_form(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("a"), F.col("id") * 7 % 900).alias("a"),
                                  F.when(F.col("id") % 5 > 0, F.concat(F.lit("b"), F.col("id") % 3)).alias("b"))
    vocab = encode.build_vocab(df.where("id < 1500"), df.where("id < 1500"), ["a", "b"])
    wide = {r["id"]: r["features"] for r in encode.one_hot_vector(df, vocab, ["a", "b"], ["id"]).collect()}
    dense = {r[0]: list(r)[1:] for r in encode.one_hot(df, vocab, ["a", "b"], ["id"]).collect()}
    for i, v in wide.items():
        full = v.toArray().tolist()
        assert full[:900] + full[901:904] == dense[i] and full[904] == (i % 5 == 0) and sum(full) == 2


def test_two_hundred_thousand_levels(spark):
    df = spark.range(200_000).select("id", F.concat(F.lit("level"), "id").alias("c"))
    got = encode.one_hot_vector(df, encode.build_vocab(df, df, ["c"]), ["c"], ["id"]).limit(50).collect()
    assert all(r["features"].size == 200_001 and r["features"].numNonzeros() == 1 for r in got)
    assert len({int(r["features"].indices[0]) for r in got}) == 50
