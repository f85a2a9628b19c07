import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propensity.operators import folds
from propensity.operators.checks import ContractError


def labelled(spark, n, rate=0.2):
    draw = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(n).withColumn("y", (draw < rate).cast("int"))


@pytest.mark.parametrize("n", [500, 1001, 10000])
def test_folds_partition_and_balance(spark, n):
    out = folds.stratified_folds(labelled(spark, n), "id", "y")
    assert out.count() == n and out.select("id").distinct().count() == n
    rows = folds.fold_audit(out, "fold", "y").collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2, 3, 4]
    sizes = [r["rows"] for r in rows]
    assert max(sizes) - min(sizes) <= 1
    rates = [r["positive_rate"] for r in rows]
    assert max(rates) - min(rates) < 0.01


def pairs(df, col="fold"):
    return {r["id"]: r[col] for r in df.collect()}


def test_folds_depend_on_seed_and_key_only(spark):
    df = labelled(spark, 1000)
    base = pairs(folds.stratified_folds(df, "id", "y", seed=1))
    assert pairs(folds.stratified_folds(df.repartition(7), "id", "y", seed=1)) == base
    assert pairs(folds.stratified_folds(df, "id", "y", seed=2)) != base


def test_folds_reject_too_few_rows(spark):
    for n in (0, 3):
        with pytest.raises(ContractError):
            folds.stratified_folds(labelled(spark, n), "id", "y")
    with pytest.raises(ContractError):
        folds.stratified_folds(labelled(spark, 30), "id", "y", k=1)


def test_folds_accept_text_classes_and_refuse_null(spark):
    df = labelled(spark, 300).withColumn("y", F.when(F.col("y") == 1, "Yes").otherwise("No"))
    assert folds.stratified_folds(df, "id", "y", 3).select("fold").distinct().count() == 3
    with pytest.raises(PySparkException, match="null class"):
        folds.stratified_folds(df.withColumn("y", F.lit(None).cast("string")), "id", "y").collect()


def test_holdout_takes_the_same_share_of_each_class(spark):
    df = labelled(spark, 2000)
    out = folds.stratified_holdout(df, "id", "y", 0.2)
    assert out.count() == 2000
    for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_if("holdout").alias("h")).collect():
        assert r["h"] == round(0.2 * r["n"])


def test_sample_sizes_are_exact(spark):
    df = labelled(spark, 2000)
    n = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    got = {r["y"]: r["count"] for r in folds.stratified_sample(df, "id", "y", 0.1, 60).groupBy("y").count().collect()}
    assert got == {y: max(60, int(0.1 * c)) for y, c in n.items()}
    assert folds.sample_fraction(df, "id", 0.33).count() == 660
    assert folds.sample_fraction(df, "id", 0.0).count() == 0
    assert folds.sample_fraction(df, "id", 1.0).count() == 2000
    assert folds.stratified_sample(df, "id", "y", 0.1, 5000).count() == 2000


def test_sample_is_the_lowest_hashes(spark):
    df = labelled(spark, 500)
    got = {r["id"] for r in folds.sample_fraction(df, "id", 0.1, seed=9).collect()}
    hashed = df.select("id", folds.key_hash("id", 9).alias("h")).orderBy("h").limit(50).collect()
    assert got == {r["id"] for r in hashed}
