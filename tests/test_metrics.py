import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.operators import metrics

ROWS = 600


def data(seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(ROWS):
        y = int(rng.random() < 0.3)
        # A third of all rows share one score and one group.
        p = 0.5 if rng.random() < 0.35 else round(min(1.0, max(0.0, rng.gauss(0.45 + 0.1 * y, 0.2))), 2)
        out.append((i, y, p, "big" if rng.random() < 0.6 else rng.choice("abc"), i % 5, rng.random()))
    return out + [(ROWS, 1, 0.3, "lone", 0, 0.1), (ROWS + 1, 1, 0.6, None, 1, 0.2)]


@pytest.fixture(scope="module")
def pdf():
    return pd.DataFrame(data(), columns=["id", "y", "p", "g", "fold", "v"])


@pytest.fixture(scope="module")
def sdf(spark):
    return spark.createDataFrame(data(), "id long, y int, p double, g string, fold int, v double").repartition(6)


@pytest.fixture(params=["few", "many"])
def ways(request):
    if request.param == "many":
        request.getfixturevalue("tiny_tasks")


def auc(y, p):
    y = np.asarray(y)
    pos, neg = y.sum(), (1 - y).sum()
    if not pos or not neg:
        return np.nan
    ranks = pd.Series(np.asarray(p)).rank().to_numpy()
    return (ranks[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)


def precision(y, p):
    df = pd.DataFrame({"y": y, "p": p}).groupby("p")["y"].agg(["sum", "count"]).sort_index(ascending=False)
    hits = df["sum"].cumsum()
    return (df["sum"] / df["sum"].sum() * hits / df["count"].cumsum()).sum()


def one(df, name):
    return df.first()[name]


def test_roc_auc(sdf, pdf, ways):
    assert one(metrics.roc_auc(sdf, "y", "p"), "auc") == pytest.approx(auc(pdf.y, pdf.p), abs=1e-12)


def test_auc_of_complement_and_monotone_map(sdf, ways):
    base = one(metrics.roc_auc(sdf, "y", "p"), "auc")
    flipped = sdf.withColumn("p", 1 - F.col("p"))
    assert one(metrics.roc_auc(flipped, "y", "p"), "auc") == pytest.approx(1 - base, abs=1e-12)
    mapped = sdf.withColumn("p", F.exp(F.col("p") * 3))
    assert one(metrics.roc_auc(mapped, "y", "p"), "auc") == pytest.approx(base, abs=1e-12)


def test_average_precision(sdf, pdf, ways):
    got = one(metrics.average_precision(sdf, "y", "p"), "average_precision")
    assert got == pytest.approx(precision(pdf.y, pdf.p), abs=1e-12)


def test_grouped_auc(sdf, pdf, ways):
    got = {r["g"]: r for r in metrics.grouped_auc(sdf, ["g"], "y", "p").collect()}
    assert None not in got and got["lone"]["auc"] is None
    for g, part in pdf.dropna().groupby("g"):
        assert got[g]["n"] == len(part) and got[g]["positive_rate"] == pytest.approx(part.y.mean())
        if g != "lone":
            assert got[g]["auc"] == pytest.approx(auc(part.y, part.p), abs=1e-12)


def test_grouped_average_precision(sdf, pdf, ways):
    got = {r["g"]: r["average_precision"] for r in metrics.average_precision(sdf, "y", "p", ["g"]).collect()}
    for g, part in pdf.dropna().groupby("g"):
        assert got[g] == pytest.approx(precision(part.y, part.p), abs=1e-12)


def test_min_count_and_single_class_groups(sdf):
    kept = metrics.conditional_auc(sdf, "y", "p", ["g"], min_count=1).collect()
    assert "lone" not in {r["g"] for r in kept}
    assert {r["g"] for r in metrics.conditional_auc(sdf, "y", "p", ["g"], min_count=200).collect()} == {"big"}


def test_subgroups_are_stacked(sdf, pdf, ways):
    got = {(r["feature"], r["value"]): r["auc"] for r in metrics.subgroup_auc(sdf, ["g", "fold"], "y", "p").collect()}
    part = pdf[pdf.fold == 2]
    assert got[("fold", "2")] == pytest.approx(auc(part.y, part.p), abs=1e-12)
    assert ("g", "big") in got


def test_auc_by_quantile(sdf, pdf, ways):
    got = metrics.auc_by_quantile(sdf, "v", "y", "p", 4).toPandas().set_index("bin")
    bins = pd.qcut(pdf.v, 4, labels=False)
    for b, part in pdf.groupby(bins):
        assert got.loc[b, "n"] == len(part)
        assert got.loc[b, "auc"] == pytest.approx(auc(part.y, part.p), abs=1e-12)
        assert got.loc[b, "mean_prediction"] == pytest.approx(part.p.mean())


def test_pooled_vs_fold(sdf, pdf, ways):
    row = metrics.pooled_vs_fold(sdf, "y", "p", "fold").first()
    per = [auc(part.y, part.p) for _, part in pdf.groupby("fold")]
    assert row["mean_auc"] == pytest.approx(np.mean(per)) and row["std_auc"] == pytest.approx(np.std(per))
    assert row["pooled_auc"] == pytest.approx(auc(pdf.y, pdf.p))


def test_confusion_counts_every_row(sdf, pdf):
    for r in metrics.confusion_at(sdf, "y", "p", [0.1, 0.5, 0.9]).collect():
        assert r["tp"] == ((pdf.p >= r["threshold"]) & (pdf.y == 1)).sum()
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(pdf)


def test_constant_baseline(sdf, pdf):
    row = metrics.constant_baseline(sdf, "y").first()
    assert row["base_rate"] == pytest.approx(pdf.y.mean()) == row["average_precision"]
    assert row["auc"] == 0.5


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert one(metrics.roc_auc(df, "y", "p"), "auc") is None
    assert one(metrics.average_precision(df.withColumn("y", F.lit(0)), "y", "p"), "average_precision") is None
