"""Model floors on the planted signal, whole jobs, and scoring of a stream."""

import math
import random

import pytest
from pyspark.sql import functions as F

from propensity.catalog import QUERIES
from propensity.operators import checks, ensemble, features, folds, impute, metrics, model, parzen, search, staged
from propensity.operators.checks import ContractError
from propensity.plans import jobs
from propensity.session import stored, work_folder
from propensity.sources import files
from propensity.sources.contract import BUYERS
from propensity.sources.ledger import RunLedger
from propensity.streaming import rowwise
from synthetic import buyers

FAST = {"num_boost_round": 6, "num_leaves": 15, "min_data_in_leaf": 20, "learning_rate": 0.2}


@pytest.fixture(scope="module")
def splits(spark, buyers_7k):
    train = checks.coerce_integral(checks.encode_target(buyers_7k, "Will_Buy_EV"), BUYERS.whole)
    test = checks.coerce_integral(buyers(spark, 1500, start=7000).drop("Will_Buy_EV"), BUYERS.whole)
    train = folds.stratified_folds(features.build_features(train), "id", "Will_Buy_EV")
    return stored(train, "train"), stored(features.build_features(test), "test")


@pytest.fixture(scope="module")
def encoded(splits):
    train, test = splits
    names, cats = features.discover_features(train.drop("fold"), "id", "Will_Buy_EV", BUYERS.categorical)
    return model.encode_frames(train, test, "id", "Will_Buy_EV", "fold", names, cats)


@pytest.fixture(scope="module")
def fitted(encoded):
    return model.fit_encoded(encoded, FAST)


def test_every_row_is_scored_once_out_of_fold(fitted):
    oof = fitted.oof
    assert oof.count() == oof.select("id").distinct().count() == 7000
    checks.require(checks.validate_predictions(oof, "prediction"))
    assert fitted.test.count() == 1500
    checks.require(checks.validate_predictions(fitted.test, "prediction"))


def test_floor(fitted):
    assert len(fitted.fold_aucs) == 5
    assert fitted.mean > 0.85 and fitted.std < 0.02
    report = {r["metric"]: r["value"] for r in model.fold_report(fitted).collect()}
    assert abs(report["pooled_auc"] - report["cv_auc_mean"]) < 0.01
    assert report["cv_auc_mean"] == pytest.approx(sum(fitted.fold_aucs) / 5)


def test_same_seed_gives_same_scores(encoded, fitted):
    again = model.fit_encoded(encoded, FAST, parallelism=1)
    assert again.fold_aucs == pytest.approx(fitted.fold_aucs, abs=1e-12)


def test_mean_of_fold_models(fitted):
    rows = fitted.data.test.limit(20)
    single = [{r["id"]: r["p"] for r in model.probability(rows, m, "p").select("id", "p").collect()}
              for m in fitted.models.values()]
    for r in model.score(rows, list(fitted.models.values())).select("id", "prediction").collect():
        assert r["prediction"] == pytest.approx(sum(s[r["id"]] for s in single) / 5)


def test_fewer_features_fit_too(splits):
    train, test = splits
    one = model.cross_val_fit(train, test, "id", "Will_Buy_EV", "fold", ["Age", "Gender"], ["Gender"], {**FAST, "num_boost_round": 2})
    assert one.mean < 0.7


def test_encoders_agree_roughly_and_logistic_beats_chance(splits, fitted):
    train, test = splits
    names, cats = features.discover_features(train.drop("fold"), "id", "Will_Buy_EV", BUYERS.categorical)
    hot = model.encode_frames(train, None, "id", "Will_Buy_EV", "fold", names, cats, "onehot")
    assert abs(model.fit_encoded(hot, FAST).mean - fitted.mean) < 0.03
    linear = model.fit_encoded(hot, kind="logistic")
    assert linear.mean > 0.85 and linear.test is None


def test_early_stopping_grows_fewer_trees(encoded):
    params = model.merge_params({**FAST, "num_boost_round": 25, "learning_rate": 0.9})
    stopped = model.fit_fold(encoded, 0, params, early_stopping=0.05)
    assert stopped.getNumTrees < 25


def test_parameters():
    merged = model.merge_params({"eta": 0.3, "n_estimators": 7, "verbose": -1, "lambda_l1": 0})
    assert merged["learning_rate"] == 0.3 and merged["num_boost_round"] == 7 and merged["seed"] == 42
    assert "verbose" not in merged
    with pytest.raises(ValueError, match="no counterpart"):
        model.merge_params({"lambda_l2": 1.0})
    with pytest.raises(ValueError, match="unknown parameter"):
        model.merge_params({"leaves": 3})
    assert model.tree_depth(merged) == 6
    assert model.tree_depth(model.merge_params({"num_leaves": 255, "max_depth": 4})) == 4
    gbt = model.make_gbt(merged, 50)
    assert (gbt.getStepSize(), gbt.getMaxIter(), gbt.getMaxBins(), gbt.getMinInstancesPerNode()) == (0.3, 7, 256, 100)


def test_search_points():
    points = search.draw_points(6, seed=1)
    assert points[0] == search.default_point() and points == search.draw_points(6, seed=1)
    assert points != search.draw_points(6, seed=2)
    for p in points:
        assert set(p) == set(search.SPACE) and all(search.SPACE[k].holds(v) for k, v in p.items())
    assert search.resolve({"max_depth": 12})["max_depth"] == -1 and search.resolve({"max_depth": 11})["max_depth"] == 11


def test_search_keeps_the_best(spark, encoded, tmp_path):
    book = RunLedger(spark, str(tmp_path / "ledger"))
    space = {"num_leaves": search.Range(2, 15, whole=True), "learning_rate": search.Range(0.01, 0.3, log=True)}
    found = search.search(encoded, 2, 5, space, {"num_boost_round": 3, "min_data_in_leaf": 20}, ledger=book)
    scores = {r["trial"]: r["score"] for r in search.trial_scores(found.trials).collect()}
    assert found.best_score == pytest.approx(max(scores.values())) and found.best_score > 0.7
    assert search.trial_scores(found.trials).first()["score"] == pytest.approx(found.best_score)
    assert {r["name"] for r in book.runs().collect()} == {"search_trial_0", "search_trial_1", "search_best"}
    assert book.best("cv_auc_mean").first()["value"] == pytest.approx(found.best_score)


def test_blend_of_equal_models_is_identity(spark):
    df = spark.range(50).select("id", (F.col("id") / 50).alias("a"), (F.col("id") / 50).alias("b"))
    out = ensemble.blend_probability(df, {"a": 0.4, "b": 0.6})
    assert all(r["blend"] == pytest.approx(r["a"]) for r in out.collect())
    ranks = ensemble.blend_rank(df, {"a": 0.4, "b": 0.6}, "id").orderBy("id").collect()
    assert [r["blend"] for r in ranks] == pytest.approx([(i + 1) / 50 for i in range(50)])


def test_stack(spark, fitted):
    noise = F.pmod(F.xxhash64("id"), F.lit(997)) / 997
    oof = fitted.oof.select("id", F.col("label").cast("int").alias("y"), F.col("prediction").alias("good"), noise.alias("noise"))
    test = fitted.test.select("id", F.col("prediction").alias("good"), noise.alias("noise"))
    result = ensemble.stack_logistic(oof, "id", "y", ["good", "noise"], test)
    got = {r["metric"]: r["value"] for r in result.report.collect()}
    assert got["rows"] == 7000 and got["auc_good"] == pytest.approx(metrics.roc_auc(oof, "y", "good").first()["auc"])
    assert got["holdout_auc_stack"] > 0.85 and abs(got["coef_noise"]) < got["coef_good"]
    assert result.beats_best == (got["holdout_auc_stack"] > max(got["holdout_auc_good"], got["holdout_auc_noise"]))
    assert result.scored.count() == 1500
    checks.require(checks.validate_predictions(result.scored, "prediction"))


def test_stack_penalty_follows_c(spark, fitted):
    oof = fitted.oof.select("id", F.col("label").cast("int").alias("y"), F.col("prediction").alias("good"))

    def weight(c):
        report = ensemble.stack_logistic(oof, "id", "y", ["good"], c=c).report.collect()
        return {r["metric"]: r["value"] for r in report}["coef_good"]

    assert weight(1e-4) < weight(1.0)


# --- whole jobs -----------------------------------------------------------------

@pytest.fixture(scope="module")
def csv_files(spark, buyers_7k, tmp_path_factory):
    base = tmp_path_factory.mktemp("input")
    paths = {n: str(base / n) for n in ("train", "test", "template")}
    buyers_7k.where("id < 3000").write.option("header", True).csv(paths["train"])
    test = buyers(spark, 500, start=7000)
    test.drop("Will_Buy_EV").write.option("header", True).csv(paths["test"])
    test.select("id", F.lit(0).alias("Will_Buy_EV"), "Gender").write.option("header", True).csv(paths["template"])
    return paths


@pytest.mark.parametrize("job, count", [(jobs.train_v1, 19), (jobs.train_v2, 30)])
def test_training_from_files_to_scored_file(spark, csv_files, tmp_path, job, count):
    out, book = str(tmp_path / "out"), RunLedger(spark, str(tmp_path / "ledger"))
    result = job(spark, csv_files["train"], csv_files["test"], csv_files["template"], out, params=FAST, ledger=book)
    assert len(result.features) == count
    assert result.summary["cv_auc_mean"] > 0.85 and result.summary["cv_auc_std"] < 0.03
    assert result.summary["average_precision"] > 0.5 and result.summary["train_rows"] == 3000
    written = spark.read.option("header", True).csv(f"{out}/scored")
    assert written.columns == ["id", "Will_Buy_EV", "Gender"] and written.count() == 500
    assert all(r["ok"] for r in result.checked.collect())
    name = job.__name__
    assert files.load_predictions(spark, f"{out}/oof", name, "id").count() == 3000
    assert files.load_predictions(spark, f"{out}/test", name, "id").count() == 500
    assert book.runs().first()["name"] == name
    logged = {r["key"]: r["value"] for r in book.metrics().collect()}
    assert logged["cv_auc_mean"] == pytest.approx(result.summary["cv_auc_mean"])


def test_training_refuses_a_template_of_other_keys(spark, splits, tmp_path):
    train, test = splits
    raw = train.drop("fold", *features.V1_NAMES).limit(400)
    other = test.select(F.col("id") + 1, F.lit(0.0).alias("Will_Buy_EV")).toDF("id", "Will_Buy_EV")
    with pytest.raises(ContractError, match="keys do not match"):
        jobs.train_frames(raw, test.drop(*features.V1_NAMES), other, "id", "Will_Buy_EV", str(tmp_path / "o"),
                          declared=BUYERS.categorical, params={**FAST, "num_boost_round": 1})
    assert not (tmp_path / "o" / "scored").exists()


def test_tuning_job(spark, csv_files, tmp_path):
    out = str(tmp_path / "out")
    space = {"num_leaves": search.Range(4, 15, whole=True)}
    result, trials = jobs.tune(spark, csv_files["train"], csv_files["test"], csv_files["template"], out, n_trials=2,
                               fixed={"num_boost_round": 3, "min_data_in_leaf": 20}, space=space)
    assert set(result.best_params) == {"num_leaves"} and trials.select("trial").distinct().count() == 2
    assert result.summary["best_score"] == pytest.approx(result.summary["cv_auc_mean"]) and result.summary["best_score"] > 0.7
    assert spark.read.option("header", True).csv(f"{out}/trials").count() == 2


def test_profile_job(spark, buyers_7k, tmp_path):
    out = str(tmp_path / "profile")
    train, test = buyers_7k.where("id < 5000"), buyers_7k.where("id >= 5000").drop("Will_Buy_EV")
    got = jobs.profile_tables(train, test, "id", "Will_Buy_EV", BUYERS.numeric, BUYERS.categorical, out=out)
    assert got["id_overlap"].first()[0] == 0 and got["train_id_unique"].first()["unique"]
    assert all(r["same"] for r in got["levels"].collect())
    assert {r["Will_Buy_EV"] for r in got["classes"].collect()} == {"Yes", "No"}
    for name in got:
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() > 0


def test_interactions_job(spark, buyers_7k, tmp_path):
    out = str(tmp_path / "mining")
    df = checks.encode_target(buyers_7k, "Will_Buy_EV", out="y")
    strong = ["Environmental_Concern_Level", "Subsidy_Available", "Range_Anxiety_Level", "Home_Charging_Possible"]
    got = jobs.interaction_tables(df, "y", BUYERS.numeric, BUYERS.categorical, strong, BUYERS.numeric[:6], out=out)
    first = got["categorical_interactions"].first()
    assert {first["feature_1"], first["feature_2"]} == {"Subsidy_Available", "Range_Anxiety_Level"}
    assert got["numeric_categorical_interactions"].count() == 42 and got["combination_frequencies"].count() == 15
    assert got["three_way_interactions"].count() == 4
    for name in got:
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() > 0


def test_error_analysis_job(spark, splits, fitted, tmp_path):
    out = str(tmp_path / "errors")
    train, _ = splits
    conditions = [(["Subsidy_Available", "Environmental_Concern_Level"], {}),
                  (["Subsidy_Available"], {"Annual_Income_USD": 10}),
                  ([], {"Environmental_Concern_Level": 5, "Annual_Income_USD": 10})]
    got = jobs.error_tables(train.drop("fold"), fitted.oof, "id", "Will_Buy_EV", BUYERS.numeric, BUYERS.categorical,
                            ["Age", "Annual_Income_USD"], conditions, 30, out)
    assert got["roc_auc"].first()["auc"] == pytest.approx(metrics.roc_auc(fitted.oof, "label", "prediction").first()["auc"])
    assert got["hard_positive"].count() == 100 and got["largest_residuals"].count() == 50
    rates = [r["actual_rate"] for r in got["deciles"].collect()]
    assert rates[-1] > rates[0]
    for name in got:
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() > 0


def test_rowwise_operators_serve_a_stream(spark, fitted, buyers_7k, tmp_path):
    """Features, encoding and scoring of arriving files equal the batch result."""
    source, out, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    raw = checks.coerce_integral(buyers_7k.where("id < 600").drop("Will_Buy_EV"), BUYERS.whole)
    raw.where("id < 300").write.parquet(source)
    models = list(fitted.models.values())

    def transform(df):
        return model.score(fitted.data.stages.transform(features.build_features(df)), models).select("id", "prediction")

    schema = spark.read.parquet(source).schema
    rowwise.write_new(rowwise.file_stream(spark, source, schema), transform, out, seen).awaitTermination(120)
    assert spark.read.parquet(out).count() == 300
    raw.where("id >= 300").write.mode("append").parquet(source)
    rowwise.write_new(rowwise.file_stream(spark, source, schema), transform, out, seen).awaitTermination(120)
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    want = {r["id"]: r["prediction"] for r in transform(raw).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i]) for i in want)


def test_work_folder_is_the_shared_one(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_work_folder_without_a_shared_one():
    class Session:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    assert work_folder(Session("local[2]"), "x").startswith("/")
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            work_folder(Session(master), "x")


def test_settings_that_name_another_objective_are_refused():
    assert model.merge_params({"objective": "binary", "metric": "auc"}) == model.merge_params()
    for wrong in ({"objective": "regression"}, {"metric": "rmse"}, {"tree_method": "exact"}):
        with pytest.raises(ValueError, match="fitted with"):
            model.merge_params(wrong)


# --- rounds and gaps ------------------------------------------------------------

def test_best_round():
    assert staged.best_round([0.5, 0.6, 0.7, 0.65, 0.7, 0.69, 0.9], 3) == (3, True)
    assert staged.best_round([0.5, 0.6, 0.7, 0.65, 0.71, 0.69], 3) == (5, False)
    assert staged.best_round([0.5], 1) == (1, False) and staged.best_round([0.5, 0.5], 1) == (1, True)
    assert staged.best_round([None, 0.5, 0.4], 2) == (2, False)


def test_margins_of_every_round(spark, encoded):
    fitted = model.fit_fold(encoded, 0, model.merge_params(FAST))
    rows = encoded.train.where("fold = 0").limit(50)
    got = {(r["id"], r["round"]): r["margin"] for r in staged.margins(rows, fitted, "id").collect()}
    assert len(got) == 50 * 6
    for n in (1, 4, 6):
        cut = staged.first_trees(fitted, n)
        assert cut.getNumTrees == n
        for r in model.probability(rows, cut, "p").select("id", "p").collect():
            assert r["p"] == pytest.approx(1 / (1 + math.exp(-2 * got[(r["id"], n)])), abs=1e-9)


def test_patience_keeps_the_best_round(encoded):
    params = {**FAST, "num_boost_round": 40, "learning_rate": 0.9}
    result = model.fit_encoded(encoded, params, patience=4)
    table = {}
    for r in result.rounds.collect():
        table.setdefault(r["fold"], {})[r["round"]] = r["auc"]
    for (k, fitted), auc in zip(sorted(result.models.items()), result.fold_aucs):
        seen = [table[k][i] for i in sorted(table[k])]
        best, ended = staged.best_round(seen, 4)
        assert fitted.getNumTrees == best and (ended or len(seen) == 40)
        assert auc == pytest.approx(seen[best - 1], abs=1e-9)
    with pytest.raises(ValueError, match="excludes"):
        model.fit_encoded(encoded, params, early_stopping=0.1, patience=4)


def gappy(df):
    """Every third age and, where someone is young, the income missing, as null or NaN."""
    age = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("Age"))
    income = F.when(F.col("Age") < 30, float("nan")).otherwise(F.col("Annual_Income_USD"))
    return df.withColumns({"Age": age, "Annual_Income_USD": income})


def test_missing_numbers_in_training(spark, splits):
    train, test = splits
    names = ["Age", "Annual_Income_USD", "Subsidy_Available", "Range_Anxiety_Level", "Environmental_Concern_Level"]
    cats = ["Subsidy_Available", "Range_Anxiety_Level"]
    data = model.encode_frames(gappy(train), gappy(test), "id", "Will_Buy_EV", "fold", names, cats)
    frame = gappy(train).select("fold", "Age", "Annual_Income_USD").toPandas()
    for k, fills in data.fills.items():
        rest = frame[frame.fold != k]
        assert fills == [rest.Age.median(), rest.Annual_Income_USD.median()]
    result = model.fit_encoded(data, FAST)
    assert result.mean > 0.8 and result.oof.count() == 7000 and result.oof.columns == ["id", "label", "fold", "prediction"]
    assert result.test.count() == 1500 and result.test.columns == ["id", "prediction"]
    checks.require(checks.validate_predictions(result.test, "prediction"))
    patient = model.fit_encoded(data, FAST, patience=2)
    assert patient.mean >= result.mean - 0.02
    # New rows, encoded by the same stages, are filled by each model itself.
    fresh = model.score(data.stages.transform(gappy(test)), list(result.models.values())).select("id", "prediction")
    want = {r["id"]: r["prediction"] for r in result.test.collect()}
    assert all(want[r["id"]] == pytest.approx(r["prediction"]) for r in fresh.collect())


def test_fold_medians(spark):
    rows = [(i % 3, None if i % 7 == 0 else float(i % 11), float("nan") if i % 2 else float(i), None) for i in range(100)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, c double")
    frame = df.toPandas()
    got = {(r["column"], r["fold"]): r["median"] for r in impute.fold_medians(df, ["a", "b", "c"], "fold").collect()}
    assert len(got) == 9
    for k in range(3):
        rest = frame[frame.fold != k]
        assert (got[("a", k)], got[("b", k)], got[("c", k)]) == (rest.a.median(), rest.b.median(), None)


# --- guided search --------------------------------------------------------------

SPACE = {"a": parzen.Range(0.01, 1.0, log=True), "b": parzen.Range(1, 4, whole=True), "c": parzen.Range(-2.0, 3.0)}


def density_by_hand(points, x):
    """Mix of a uniform and of cut normal kernels, the cut found by summing a fine grid."""
    def unit(name, v):
        return math.log(v / 0.01) / math.log(100) if name == "a" else (v - 0.5) / 4 if name == "b" else (v + 2) / 5
    width = 0.2 * len(points) ** (-1 / 7)
    steps = [(i + 0.5) / 20_000 for i in range(20_000)]
    total = 0.25
    for p in points:
        product = 1.0
        for n in "abc":
            c, u = unit(n, p[n]), unit(n, x[n])
            bell = [math.exp(-((s - c) / width) ** 2 / 2) for s in steps]
            mass = sum(bell) / len(steps)
            if n == "b":
                product *= sum(b for s, b in zip(steps, bell) if abs(s - u) <= 0.125) / len(steps) / mass
            else:
                product *= math.exp(-((u - c) / width) ** 2 / 2) / mass
        total += product
    return total / (len(points) + 1)


def test_density_against_brute_force():
    points = [{"a": 0.02, "b": 1, "c": -2.0}, {"a": 0.9, "b": 3, "c": 1.5}, {"a": 0.3, "b": 3, "c": 1.0}]
    made = parzen.Density(SPACE, points)
    for x in (*points, {"a": 0.05, "b": 2, "c": 3.0}, {"a": 1.0, "b": 4, "c": 0.0}):
        assert made.at(x) == pytest.approx(density_by_hand(points, x), rel=1e-3)


def test_drawn_points_follow_the_density():
    rng = random.Random(3)
    made = parzen.Density({"b": SPACE["b"]}, [{"b": 2}, {"b": 2}, {"b": 4}])
    drawn = [made.draw(rng)["b"] for _ in range(20_000)]
    for v in (1, 2, 3, 4):
        assert drawn.count(v) / len(drawn) == pytest.approx(made.at({"b": v}), abs=0.015)
    assert sum(made.at({"b": v}) for v in (1, 2, 3, 4)) == pytest.approx(1)
    assert all(SPACE[k].holds(v) for _ in range(300) for k, v in parzen.Density(SPACE, []).draw(rng).items())


def test_guided_points_go_where_the_score_is():
    def score(p):
        return -abs(math.log(p["a"] / 0.1)) - abs(p["c"] - 1) - (p["b"] != 3)
    def run(seed, guided):
        trials, rng = [], random.Random(seed)
        for _ in range(40):
            p = (parzen.propose(trials, SPACE, seed) if guided and len(trials) >= 10
                 else {k: r.draw(rng) for k, r in SPACE.items()})
            trials.append((p, score(p)))
        return trials
    better = sum(max(s for _, s in run(k, True)) > max(s for _, s in run(k, False)) for k in range(10))
    assert better >= 8
    trials = run(0, True)[:20]
    assert parzen.propose(trials, SPACE, 1) == parzen.propose(trials, SPACE, 1) != parzen.propose(trials, SPACE, 2)


def test_search_goes_on_from_its_ledger(spark, monkeypatch, tmp_path):
    asked = []

    class Result:
        def __init__(self, point):
            self.mean = 1 - abs(point["c"] - 1) / 9

    def fit(data, params, **options):
        asked.append(dict(params))
        return Result(params)

    class Data:
        train = spark.range(1)
    monkeypatch.setattr(search, "fit_encoded", fit)
    monkeypatch.setattr(search, "default_point", lambda space: {"a": 0.5, "b": 2, "c": 0.0})
    whole = search.search(Data, 30, 5, SPACE)
    points = asked[:]
    assert points[0] == {"a": 0.5, "b": 2, "c": 0.0} and len(points) == 30
    asked.clear()
    book = RunLedger(spark, str(tmp_path / "ledger"))
    search.search(Data, 13, 5, SPACE, ledger=book)
    book.append(book.start("search_trial_13"), {"a": 0.5})  # cut off: no score
    found = search.search(Data, 30, 5, SPACE, ledger=book)
    assert asked == points or asked[:30] == points
    assert (found.best_params, found.best_score) == (whole.best_params, whole.best_score)
    before = len(asked)
    again = search.search(Data, 30, 5, SPACE, ledger=book)
    assert len(asked) == before + 1 and again.best_params == whole.best_params  # only the best point is fitted anew


def test_trees_of_models_that_fill_gaps(spark, folder):
    rows = QUERIES["cross_val_early_stopping"](spark, folder).orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [0, 1, 2, 3, 4]
    assert all(1 <= r["trees"] <= 30 and 0.6 < r["auc"] <= 1 for r in rows)
