"""Queries over whole jobs, compared with SQL; jobs that refuse what does not fit."""

import pytest
from pyspark.sql import functions as F

import compare
from __spark_entry__ import oracle_sql
from propensity.operators import features, model
from propensity.operators.checks import ContractError
from propensity.plans import jobs
from propensity.sources import frames
from shared import FOLDER

JOBS = sorted(n for n in oracle_sql() if n.startswith("job_"))


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", JOBS)
def test_equals_sql(spark, con, name):
    assert compare.differences(spark, con, name, FOLDER) is None


def preds(spark, n, shift=0.0):
    return spark.range(n).select("id", ((F.col("id") % 10) / 10 + shift).alias("prediction"))


def test_stack_refuses_models_and_keys_that_do_not_fit(spark, tmp_path):
    labelled = spark.range(100).select("id", (F.col("id") % 10 > 4).cast("int").alias("y"))
    template = labelled.select("id", F.lit(0.0).alias("y"))
    good = {"a": preds(spark, 100), "b": preds(spark, 100, 0.05)}
    with pytest.raises(ContractError, match="test predictions"):
        jobs.stack(good, {"a": good["a"]}, labelled, template, "id", "y", "y", str(tmp_path / "x"))
    with pytest.raises(ContractError, match="do not align"):
        jobs.stack({**good, "b": preds(spark, 99)}, good, labelled, template, "id", "y", "y", str(tmp_path / "x"))
    with pytest.raises(ContractError):
        jobs.stack(good, good, labelled.where("id > 0"), template, "id", "y", "y", str(tmp_path / "x"))
    found, checked = jobs.stack(good, good, labelled, template, "id", "y", "y", str(tmp_path / "out"))
    report = {r["metric"]: r["value"] for r in found.report.collect()}
    assert report["rows"] == 100 and report["auc_a"] == 1.0 and all(r["ok"] for r in checked.collect())
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "report")).count() == found.report.count()


def test_compare_changes_one_setting_on_the_same_folds(spark, tmp_path):
    df = frames.planted_frame(spark, FOLDER).where("split = 'train'").drop("split")
    few = {"num_boost_round": 2, "num_leaves": 4}
    told = [*frames.NUMBERS, "rich", "urgency", "priority", *features.feature_names("v1")]
    settings = {"all": jobs.Setting(params=few), "again": jobs.Setting(params=few), "less": jobs.Setting(without=told, params=few)}
    table = jobs.compare(df, "id", "y", settings, frames.ROLES, frames.CATEGORIES, k=3, out=str(tmp_path / "t"))
    got = {}
    for r in table.collect():
        got.setdefault(r["setting"], {})[r["metric"]] = r["value"]
    assert got["all"] == got["again"] and len(got["all"]) == 6
    assert got["less"]["cv_auc_mean"] < got["all"]["cv_auc_mean"]
    assert spark.read.option("header", True).csv(str(tmp_path / "t" / "comparison")).count() == 18


@pytest.mark.parametrize("patience", [None, 2])
def test_a_job_cut_off_between_folds_goes_on(spark, monkeypatch, tmp_path, patience):
    df = frames.planted_frame(spark, FOLDER)
    train, test = df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split", "y")
    template = test.select("id", F.lit(0.0).alias("y"))
    fitted, real = [], model.fit_fold

    def run(out, fail_at=None, **options):
        def fit(data, k, *rest):
            if k == fail_at:
                raise RuntimeError("cut off")
            fitted.append(k)
            return real(data, k, *rest)
        monkeypatch.setattr(model, "fit_fold", fit)
        return jobs.train_frames(train, test, template, "id", "y", str(tmp_path / out), roles=frames.ROLES, declared=frames.CATEGORIES,
                                 params={"num_boost_round": 3, "num_leaves": 4}, k=3, patience=patience, **options)
    folder = str(tmp_path / "stages")
    with pytest.raises(RuntimeError, match="cut off"):
        run("a", 2, resume=folder)
    assert sorted(set(fitted)) == [0, 1] and (tmp_path / "stages").exists()
    fitted.clear()
    resumed = run("b", resume=folder)
    assert set(fitted) == {2} and not (tmp_path / "stages").exists()
    fitted.clear()
    whole = run("c")
    assert set(fitted) == {0, 1, 2}
    assert resumed.summary == pytest.approx(whole.summary)
