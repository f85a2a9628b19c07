"""The whole jobs: two trainings, tuning, blends, stacking, comparison of settings, profile, interaction mining, error analysis.

Each takes DataFrames (training also paths), writes its results under an output folder
and returns the tables. A frame that several steps read is stored once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions import columns as fx
from propensity.operators import align, checks, ensemble, features, folds, metrics, model, order, profile, rates
from propensity.operators import search as tuning
from propensity.operators.features import Roles
from propensity.session import stored
from propensity.sources import files
from propensity.sources.contract import BUYERS, TableContract
from propensity.sources.ledger import RunLedger
from propensity.sources.stages import Stages


@dataclass
class TrainResult:
    summary: dict[str, float]
    cv: model.CvResult
    scored: DataFrame
    checked: DataFrame  # read-back report
    features: list[str]
    best_params: dict[str, object] = field(default_factory=dict)


def _ready(train: DataFrame, test: DataFrame, key: str, y: str, spec: str, roles: Roles,
           k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Validated splits with features, and folds on the training side, stored."""
    checks.require(checks.validate_raw(train, key, y), "train")
    checks.require(checks.validate_raw(test, key), "test")
    checks.require(checks.validate_binary(train, y), "target")
    built = features.build_features(train, spec, roles)
    ready = stored(folds.stratified_folds(built, key, y, k, seed), "train")
    scored = stored(features.build_features(test, spec, roles), "test")
    checks.column_parity(ready.drop("fold"), scored, key, y)
    return ready, scored


def _finish(cv: model.CvResult, template: DataFrame, key: str, y: str, out: str, name: str, spec: str,
            names: list[str], form: str, ledger: RunLedger | None, extra: Mapping[str, float] | None = None) -> TrainResult:
    """Validate, write and read back the scored file; save predictions; log the run."""
    checks.require(checks.validate_predictions(cv.oof, "prediction"), "out-of-fold predictions")
    test = stored(cv.test, "scores")
    scored = align.apply_template(template, test, key, y)
    path = files.write_scored(scored, f"{out}/scored", key, form)
    checked = files.verify_written(path, scored, key, y, form)
    checks.require(checked, path)
    files.save_predictions(cv.oof, f"{out}/oof", name, key)
    files.save_predictions(test, f"{out}/test", name, key)

    n = cv.data.rows
    stats = profile.prediction_stats(test, "prediction").first()
    ap = metrics.average_precision(cv.oof, "label", "prediction").first()[0]
    pooled = metrics.roc_auc(cv.oof, "label", "prediction").first()["auc"]
    summary = {**cv.metrics(), "pooled_auc": pooled, "average_precision": ap, "train_rows": float(n),
               "scored_min": stats["min"], "scored_max": stats["max"], "scored_mean": stats["mean"], **(extra or {})}
    if ledger is not None:
        run = ledger.start(name, {**summary, "features": len(names), "spec": spec})
        ledger.append(run, cv.params, summary)
    return TrainResult(summary, cv, scored, checked, names)


def train_frames(train: DataFrame, test: DataFrame, template: DataFrame, key: str, y: str, out: str, spec: str = "v1",
                 roles: Roles = Roles(), declared: Sequence[str] = (), params: Mapping[str, object] | None = None,
                 encoder: str = "codes", kind: str = "gbt", early_stopping: float | None = None, k: int = 5,
                 seed: int = 42, name: str = "train", form: str = "csv", ledger: RunLedger | None = None,
                 fill: Mapping[str, float] | None = None, patience: int | None = None, resume: str | None = None) -> TrainResult:
    """Features, folds, k-fold fit, evaluation, scored file with read-back.

    Missing numbers are filled by fold medians unless ``fill`` names a value; ``patience`` ends a fold's trees
    after so many rounds without gain. ``resume`` names a folder for the fold models as they are fitted: a job that was
    cut off takes those it finds from there, and removes the folder when it is done.
    """
    ready, scored = _ready(train, test, key, y, spec, roles, k, seed)
    if fill:
        ready, scored = ready.na.fill(dict(fill)), scored.na.fill(dict(fill))
    names, cats = features.discover_features(ready.drop("fold"), key, y, declared)
    cv = model.cross_val_fit(ready, scored, key, y, "fold", names, cats, params, encoder, kind, early_stopping,
                             patience=patience, stages=None if resume is None else Stages(train.sparkSession, resume))
    result = _finish(cv, template, key, y, out, name, spec, names, form, ledger)
    if resume is not None:
        Stages(train.sparkSession, resume).remove()
    return result


def _template(spark: SparkSession, path: str, test: DataFrame, key: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    kind = dict(test.dtypes)[key]
    return raw.withColumn(key, F.col(key).cast(kind))


def _train_files(spark: SparkSession, train_path: str, test_path: str, template_path: str, out: str, spec: str,
                 contract: TableContract, form: str, **options) -> TrainResult:
    train, test = files.load_pair(spark, train_path, test_path, contract, form)
    template = _template(spark, template_path, test, contract.key)
    return train_frames(train, test, template, contract.key, contract.target, out, spec,
                        declared=contract.categorical, **options)


def train_v1(spark: SparkSession, train_path: str, test_path: str, template_path: str, out: str,
             contract: TableContract = BUYERS, form: str = "csv", **options) -> TrainResult:
    """Six engineered features; from files to a scored file."""
    return _train_files(spark, train_path, test_path, template_path, out, "v1", contract, form,
                        name=options.pop("name", "train_v1"), **options)


def train_v2(spark: SparkSession, train_path: str, test_path: str, template_path: str, out: str,
             contract: TableContract = BUYERS, form: str = "csv", **options) -> TrainResult:
    """Seventeen engineered features; string crosses are found and encoded as categories."""
    return _train_files(spark, train_path, test_path, template_path, out, "v2", contract, form,
                        name=options.pop("name", "train_v2"), **options)


def tune_frames(train: DataFrame, test: DataFrame, template: DataFrame, key: str, y: str, out: str,
                roles: Roles = Roles(), declared: Sequence[str] = (), n_trials: int = 25, seed: int = 42, k: int = 5,
                fixed: Mapping[str, object] | None = None, space: Mapping[str, tuning.Range] = tuning.SPACE,
                early_stopping: float | None = None, name: str = "tune", form: str = "csv",
                ledger: RunLedger | None = None, fill: Mapping[str, float] | None = None,
                patience: int | None = None) -> tuple[TrainResult, DataFrame]:
    """Search, then the scored file of the best point. Returns the result and all trials."""
    ready, scored = _ready(train, test, key, y, "v1", roles, k, seed)
    if fill:
        ready, scored = ready.na.fill(dict(fill)), scored.na.fill(dict(fill))
    names, cats = features.discover_features(ready.drop("fold"), key, y, declared)
    data = model.encode_frames(ready, scored, key, y, "fold", names, cats)
    found = tuning.search(data, n_trials, seed, space, fixed, early_stopping, ledger, name, patience=patience)
    files.write_report(found.trials, f"{out}/trials")
    result = _finish(found.best, template, key, y, out, name, "v1", names, form, ledger,
                     {"best_score": found.best_score, "n_trials": float(n_trials)})
    result.best_params = found.best_params
    return result, found.trials


def tune(spark: SparkSession, train_path: str, test_path: str, template_path: str, out: str,
         contract: TableContract = BUYERS, form: str = "csv", **options) -> tuple[TrainResult, DataFrame]:
    train, test = files.load_pair(spark, train_path, test_path, contract, form)
    template = _template(spark, template_path, test, contract.key)
    return tune_frames(train, test, template, contract.key, contract.target, out, declared=contract.categorical, **options)


def blend(predictions: Mapping[str, DataFrame], template: DataFrame, key: str, target: str, weights: Mapping[str, float],
          out: str, by_rank: bool = False, form: str = "csv") -> tuple[DataFrame, DataFrame]:
    """Saved predictions of several models to one scored file: align, blend, fill the template, write, read back.

    Weights belong to the models of the same names. Gives the scored table and the report of
    the read-back; keys or values that do not fit fail before anything is written.
    """
    if set(weights) != set(predictions):
        raise checks.ContractError(f"weights for {sorted(weights)}, predictions of {sorted(predictions)}")
    aligned = stored(align.align_models(predictions, key), "aligned")
    mixed = (ensemble.blend_rank(aligned, weights, key, "prediction") if by_rank
             else ensemble.blend_probability(aligned, weights, "prediction"))
    scored = align.apply_template(template, stored(mixed.select(key, "prediction"), "blend"), key, target)
    path = files.write_scored(scored, f"{out}/scored", key, form)
    checked = files.verify_written(path, scored, key, target, form)
    checks.require(checked, path)
    return scored, checked


def stack(oof: Mapping[str, DataFrame], test: Mapping[str, DataFrame], labelled: DataFrame, template: DataFrame, key: str,
          y: str, target: str, out: str, c: float = 1.0, holdout: float = 0.2, seed: int = 42,
          form: str = "csv") -> tuple[ensemble.StackResult, DataFrame]:
    """Saved predictions of several models to one scored file by a second-level logistic model.

    Out-of-fold predictions and labels are aligned by key, the model is judged on a held-out part beside each
    single model, fitted again on all rows, and its test scores go into the template, are written and read back.
    Gives the result with its report, which is also written, and the read-back.
    """
    if set(oof) != set(test):
        raise checks.ContractError(f"out-of-fold predictions of {sorted(oof)}, test predictions of {sorted(test)}")
    checks.require(checks.validate_binary(labelled, y), "target")
    level = stored(align.attach(labelled.select(key, y), align.align_models(oof, key), key), "level")
    found = ensemble.stack_logistic(level, key, y, list(oof), stored(align.align_models(test, key), "aligned"), c, holdout, seed)
    files.write_report(found.report, f"{out}/report")
    scored = align.apply_template(template, stored(found.scored, "stack"), key, target)
    path = files.write_scored(scored, f"{out}/scored", key, form)
    checked = files.verify_written(path, scored, key, target, form)
    checks.require(checked, path)
    return found, checked


@dataclass(frozen=True)
class Setting:
    """What one row of a comparison fits: feature set, encoder, columns left out, parameters, estimator."""
    spec: str = "v1"
    encoder: str = "codes"
    without: Sequence[str] = ()
    params: Mapping[str, object] = field(default_factory=dict)
    kind: str = "gbt"


def compare(train: DataFrame, key: str, y: str, settings: Mapping[str, Setting], roles: Roles = Roles(), declared: Sequence[str] = (),
            k: int = 5, seed: int = 42, out: str | None = None, patience: int | None = None) -> DataFrame:
    """(setting, features, metric, value): each setting fitted on the same folds, one setting changed at a time or several.

    Folds depend on key, class and seed only, so a difference between two settings is theirs.
    """
    checks.require(checks.validate_raw(train, key, y), "train")
    checks.require(checks.validate_binary(train, y), "target")
    base = stored(folds.stratified_folds(train, key, y, k, seed), "folds")
    rows = []
    for name, setting in settings.items():
        built = features.build_features(base, setting.spec, roles).drop(*setting.without)
        names, cats = features.discover_features(built.drop("fold"), key, y, declared)
        cv = model.cross_val_fit(built, None, key, y, "fold", names, cats, setting.params, setting.encoder, setting.kind,
                                 patience=patience if setting.kind == "gbt" else None)
        pooled = metrics.roc_auc(cv.oof, "label", "prediction").first()["auc"]
        rows += [(name, len(names), m, float(v)) for m, v in {**cv.metrics(), "pooled_auc": pooled}.items()]
    table = train.sparkSession.createDataFrame(rows, "setting string, features int, metric string, value double")
    return _write_all({"comparison": table}, out)["comparison"]


def _write_all(tables: Mapping[str, DataFrame], out: str | None) -> dict[str, DataFrame]:
    if out is not None:
        for name, table in tables.items():
            files.write_report(table, f"{out}/{name}")
    return dict(tables)


def profile_tables(train: DataFrame, test: DataFrame, key: str, target: str, nums: Sequence[str], cats: Sequence[str],
                   classes: tuple[object, object] = ("No", "Yes"), out: str | None = None,
                   bins: int = 30) -> dict[str, DataFrame]:
    """Integrity and signal report of both splits."""
    tables = {
        "shape": profile.shape_types(train),
        "train_id_unique": profile.is_unique(train, key),
        "test_id_unique": profile.is_unique(test, key),
        "id_overlap": align.id_overlap(train, test, key).agg(F.count(F.lit(1)).alias("overlap")),
        "train_missing": profile.missing_counts(train),
        "test_missing": profile.missing_counts(test),
        "duplicates": profile.duplicate_rows(train, exclude=[key]),
        "classes": profile.value_counts(train, target),
        "levels": profile.level_consistency(train, test, cats),
        "train_numbers": profile.describe(train, nums),
        "test_numbers": profile.describe(test, nums),
        "class_means": profile.class_means(train, nums, target, *classes),
        **{f"histogram_{c}": profile.histogram(train, c, bins, target).orderBy(target, "bin") for c in nums},
        "crosstabs": profile.crosstab_shares(train, cats, target, list(classes)).orderBy("feature", "value"),
    }
    return _write_all(tables, out)


def interaction_tables(df: DataFrame, y: str, nums: Sequence[str], cats: Sequence[str], strong: Sequence[str],
                       digits: Sequence[str], roles: Roles = Roles(), min_count: int = 100,
                       mods: Sequence[int] = (2, 3, 5, 10, 100), out: str | None = None,
                       pairs: Sequence[tuple[str, str]] = ()) -> dict[str, DataFrame]:
    """Target rates over one, two and three columns, the named pairs in full, digit audit, correlations."""
    r = roles
    ratios = {
        "income_per_age": fx.ratio(r.income, r.age, offset=1),
        "income_per_commute": fx.ratio(r.income, r.commute, offset=1),
        "stations_total": fx.row_sum(r.home, r.work),
        "stations_difference": fx.row_diff(r.work, r.home),
        "work_stations_per_commute": fx.ratio(r.work, r.commute, offset=1),
        "home_stations_per_commute": fx.ratio(r.home, r.commute, offset=1),
    }
    by_range = F.desc("rate_range")
    tables = {
        "missing": profile.missing_counts(df),
        "duplicates": profile.duplicate_rows(df),
        "rates": rates.target_rates(df, cats, y).orderBy("feature", F.desc("mean"), "value"),
        **{f"pair_{a}_{b}": rates.interaction_table(df, a, b, y, min_count).orderBy(a, b) for a, b in pairs},
        "profiles": rates.numeric_profiles(df, nums, y, 10).orderBy("column", "bin"),
        "categorical_interactions": rates.pair_interactions(df, cats, y, min_count)
        .orderBy(by_range, "feature_1", "feature_2"),
        "numeric_categorical_interactions": rates.numeric_cat_interactions(df, nums, cats, y, 5, min_count)
        .orderBy(by_range, "numerical", "categorical"),
        "three_way_interactions": rates.triple_interactions(df, strong, y, min_count).orderBy(by_range, "features"),
        "combination_frequencies": rates.combo_frequencies(df, cats).orderBy("features"),
        "digit_artifacts": rates.modulo_audit(df, digits, mods, y, min_count)
        .orderBy(F.desc("max_deviation"), "feature", "operation"),
        "correlations": profile.corr_wide(profile.corr_matrix(df, [*nums, y]), [*nums, y]),
        "ratio_correlations": profile.corr_with_target(df, ratios, y).orderBy(F.desc("corr")),
    }
    return _write_all(tables, out)


def error_tables(df: DataFrame, preds: DataFrame, key: str, y: str, nums: Sequence[str], cats: Sequence[str],
                 mod_cols: Sequence[str], conditions: Sequence[tuple[Sequence[str], Mapping[str, int]]] = (),
                 min_count: int = 500, out: str | None = None) -> dict[str, DataFrame]:
    """Diagnostics of one model's out-of-fold predictions, joined by key and stored once."""
    p = "prediction"
    joined = stored(features.residuals(align.attach(df, preds.select(key, p), key), y, p), "analysis")
    cuts = order.cut_points(joined, p)
    # One hundred rows each, read by many tables below.
    hard, easy = (stored(order.top_k(joined, p, 100, key, ascending=k == 1, where=F.col(y) == k), "hard")
                  for k in (1, 0))
    pair = ("hard_positive", "hard_negative")
    tables = {
        "stats": profile.prediction_stats(joined, p),
        "roc_auc": metrics.roc_auc(joined, y, p, cuts=cuts),
        "average_precision": metrics.average_precision(joined, y, p, cuts=cuts),
        "histogram": profile.histogram(joined, p, 100, y),
        "deciles": order.decile_table(joined, p, y, 10).orderBy("bin"),
        "subgroups": metrics.subgroup_auc(joined, cats, y, p, cuts=cuts).orderBy("auc", "feature", "value"),
        "largest_residuals": order.top_k(joined, "abs_residual", 50, key).select(key, y, p, "residual", "abs_residual"),
        "hard_positive": hard, "hard_negative": easy,
        "hard_means": profile.group_means(hard, easy, nums, pair),
        "modulo_residuals": rates.modulo_residual_audit(joined, mod_cols, (2, 3, 5, 10, 100), y, p),
    }
    tables["auc_by_quantile"] = metrics.auc_by_quantiles(joined, nums, y, p, 10, cuts).orderBy("column", "bin")
    tables |= {f"hard_share_{c}": align.compare_shares(hard, easy, c, pair) for c in cats}
    for by, bins in conditions:
        label = "_".join([*by, *[f"{c}{q}" for c, q in bins.items()]])
        tables[f"conditional_{label}"] = metrics.conditional_auc(
            joined, y, p, by, dict(bins), min_count, cuts).orderBy("auc")
    return _write_all(tables, out)
