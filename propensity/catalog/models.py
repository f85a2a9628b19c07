"""Model queries on orders whose outcome follows their columns.

Fits have no SQL twin. Where a table of a whole job equals a single operator, its SQL is
that operator's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.catalog import alignment, evaluation, profiling, rates  # noqa: F401  (their SQL is reused below)
from propensity.catalog.registry import ORACLES, P, auc_sql, query, rounded, with_p
from propensity.operators import encode, ensemble, features, folds, impute, model, order, search
from propensity.plans import jobs
from propensity.session import stored, work_folder
from propensity.sources import files, frames, ledger

ROUNDS = {"num_boost_round": 10, "num_leaves": 15}


def planted_splits(spark, folder, spec="v1") -> tuple[DataFrame, DataFrame]:
    df = features.build_features(frames.planted_frame(spark, folder), spec, frames.ROLES)
    df = stored(df, "planted")
    train = stored(folds.stratified_folds(df.where("split = 'train'"), "id", "y").drop("split"), "folds")
    return train, df.where("split = 'test'").drop("split", "y")


def encoded(spark, folder, encoder="codes", spec="v1") -> model.Encoded:
    train, test = planted_splits(spark, folder, spec)
    names, cats = features.discover_features(train.drop("fold"), "id", "y", frames.CATEGORIES)
    return model.encode_frames(train, test, "id", "y", "fold", names, cats, encoder)


@query()
def cross_val_trees(spark, folder):
    """Fold, mean and pooled AUC of boosted trees."""
    return model.fold_report(model.fit_encoded(encoded(spark, folder), ROUNDS))


@query()
def cross_val_trees_one_hot(spark, folder):
    return model.fold_report(model.fit_encoded(encoded(spark, folder, "onehot"), ROUNDS))


def _trees(result) -> list[tuple[int, int, float]]:
    """Fold, number of trees and AUC of each fold's model."""
    return [(k, model.parts(m)[1].getNumTrees, a) for (k, m), a in zip(sorted(result.models.items()), result.fold_aucs)]


@query()
def cross_val_early_stopping(spark, folder):
    """Trees that a tolerance of the loss leaves to each fold's model, and its AUC."""
    result = model.fit_encoded(encoded(spark, folder), {**ROUNDS, "num_boost_round": 30, "learning_rate": 0.3},
                               early_stopping=0.01)
    return spark.createDataFrame(_trees(result), "fold int, trees int, auc double")


@query()
def logistic_baseline(spark, folder):
    return model.fold_report(model.fit_encoded(encoded(spark, folder, "onehot"), kind="logistic"))


@query()
def scored_test_split(spark, folder):
    """Mean of the fold models for every row of the test split."""
    return model.fit_encoded(encoded(spark, folder), ROUNDS).test


@query()
def stack_of_two_models(spark, folder):
    trees = model.fit_encoded(encoded(spark, folder), ROUNDS).oof
    linear = model.fit_encoded(encoded(spark, folder, "onehot"), kind="logistic").oof
    both = (trees.select("id", F.col("label").alias("y"), F.col("prediction").alias("trees"))
            .join(linear.select("id", F.col("prediction").alias("linear")), "id"))
    return ensemble.stack_logistic(both, "id", "y", ["trees", "linear"]).report


@query()
def search_trials(spark, folder):
    found = search.search(encoded(spark, folder), 3, fixed={"num_boost_round": 5},
                          ledger=ledger.RunLedger(spark, work_folder(spark, "ledger")))
    return found.trials


def _job_splits(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    df = stored(frames.planted_frame(spark, folder), "planted")
    test = df.where("split = 'test'").drop("split", "y")
    template = test.select("id", F.lit(0.0).alias("y"), F.col("segment").alias("extra"))
    return df.where("split = 'train'").drop("split"), test, template


def _summary(spark, summary) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(summary.items())], "metric string, value double")


def _train_job(spark, folder, spec) -> DataFrame:
    train, test, template = _job_splits(spark, folder)
    out = work_folder(spark, f"train-{spec}")
    result = jobs.train_frames(train, test, template, "id", "y", out, spec, frames.ROLES, frames.CATEGORIES, ROUNDS,
                               name=f"train_{spec}", ledger=ledger.RunLedger(spark, f"{out}/ledger"))
    return _summary(spark, result.summary)


@query()
def job_train_v1(spark, folder):
    return _train_job(spark, folder, "v1")


@query()
def job_train_v2(spark, folder):
    return _train_job(spark, folder, "v2")


@query()
def job_tune(spark, folder):
    train, test, template = _job_splits(spark, folder)
    out = work_folder(spark, "tune")
    result, _ = jobs.tune_frames(train, test, template, "id", "y", out, frames.ROLES, frames.CATEGORIES, n_trials=2,
                                 fixed={"num_boost_round": 5}, ledger=ledger.RunLedger(spark, f"{out}/ledger"))
    return _summary(spark, result.summary)


@query(ORACLES["level_consistency"])
def job_profile_levels(spark, folder):
    cats = ["region", "segment", "qty"]
    df = stored(frames.orders_frame(spark, folder, ["id", "split", "amount", "target", *cats]), "orders")
    train, test = (df.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    return jobs.profile_tables(train, test, "id", "target", ["amount"], cats, out=work_folder(spark, "profile"))["levels"]


@query(ORACLES["pair_interactions"])
def job_interactions_pairs(spark, folder):
    df = stored(frames.orders_frame(spark, folder, [*frames.NUMBERS, *frames.CATEGORIES, "y"]), "orders")
    tables = jobs.interaction_tables(df, "y", ["amount", "qty"], frames.CATEGORIES, frames.CATEGORIES, ["qty", "nation"],
                                     frames.ROLES, out=work_folder(spark, "interactions"))
    return rounded(tables["categorical_interactions"])


@query(ORACLES["subgroup_auc"])
def job_errors_subgroups(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "y", "score_a", *frames.NUMBERS, *frames.CATEGORIES])
    preds = df.select("id", F.col("score_a").alias("prediction"))
    tables = jobs.error_tables(df.drop("score_a"), preds, "id", "y", ["amount", "qty"], frames.CATEGORIES,
                               ["qty", "nation"], [(["rich"], {}), (["rich"], {"amount": 10})], 50,
                               out=work_folder(spark, "errors"))
    return rounded(tables["subgroups"])


@query(f"""
  WITH p AS ({P}), n AS (SELECT count(*) AS n FROM p WHERE split = 'train')
  SELECT CAST(k AS INTEGER) AS fold, (n - k + 4) // 5 AS rows, (n - k + 4) // 5 AS keys, (n - k + 4) // 5 AS in_range,
         true AS above_floor
  FROM n, (VALUES (0), (1), (2), (3), (4)) f(k)""")
def out_of_fold_audit(spark, folder):
    """What was scored out of fold: rows, distinct keys, scores within 0 and 1, AUC above 0.6, by fold."""
    result = model.fit_encoded(encoded(spark, folder), ROUNDS)
    auc = spark.createDataFrame([(k, a) for k, a in zip(sorted(result.models), result.fold_aucs)], "fold int, auc double")
    found = result.oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("keys"),
        F.count_if(F.col("prediction").between(0.0, 1.0)).alias("in_range"))
    return found.join(auc, "fold").select("fold", "rows", "keys", "in_range", (F.col("auc") > 0.6).alias("above_floor"))


@query(f"SELECT id, true AS in_range FROM ({P}) p WHERE split = 'test'")
def scored_test_keys(spark, folder):
    """Every row of the test split, and whether its score is a probability."""
    return model.fit_encoded(encoded(spark, folder), ROUNDS).test.select("id", F.col("prediction").between(0.0, 1.0).alias("in_range"))


@query(ORACLES["blend_of_ranks"])
def job_blend_ranks(spark, folder):
    """Two saved models blended by rank into a template, written and read back."""
    df = frames.orders_frame(spark, folder, ["id", "score_a", "score_b"])
    out = work_folder(spark, "blend")
    for name in ("a", "b"):
        files.save_predictions(df, out, name, "id", f"score_{name}")
    saved = {name: files.load_predictions(spark, out, name, "id") for name in ("a", "b")}
    weights = dict(zip(("a", "b"), ensemble.RANK_WEIGHTS))
    scored, _ = jobs.blend(saved, df.select("id", F.lit(0.0).alias("blend")), "id", "blend", weights, out, by_rank=True)
    return rounded(files.read_back(spark, f"{out}/scored", scored.schema))


@query(with_p(profiling._histogram_sql("p", "amount", 30, "target")))
def job_profile_histogram(spark, folder):
    """The histogram of amounts among the tables of the profile job."""
    df = stored(frames.orders_frame(spark, folder, ["id", "split", "amount", "target", "region"]), "orders")
    train, test = (df.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    tables = jobs.profile_tables(train.unionByName(test), test, "id", "target", ["amount"], ["region"])
    return rounded(tables["histogram_amount"], 5, density=8)


@query(ORACLES["interaction_table"])
def job_interactions_named_pair(spark, folder):
    """One named pair in full among the tables of the interaction job."""
    df = stored(frames.orders_frame(spark, folder, [*frames.NUMBERS, *frames.CATEGORIES, "y"]), "orders")
    tables = jobs.interaction_tables(df, "y", ["amount"], frames.CATEGORIES, frames.CATEGORIES, ["qty"], frames.ROLES,
                                     pairs=[("rich", "urgency")])
    return rounded(tables["pair_rich_urgency"])


PATIENCE = 3


@query("SELECT CAST(k AS INTEGER) AS fold, true AS rounds_are_whole, true AS trees_end_at_the_best, true AS auc_is_that_round_s "
       "FROM (VALUES (0), (1), (2), (3), (4)) f(k)")
def early_stopping_audit(spark, folder):
    """Trees kept by patience against the round that follows from the stored AUC of every round, by fold."""
    result = model.fit_encoded(encoded(spark, folder), {**ROUNDS, "num_boost_round": 30, "learning_rate": 0.6}, patience=PATIENCE)
    so_far = Window.partitionBy("fold").orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    best = F.max(F.struct("auc", (-F.col("round")).alias("r"))).over(so_far)
    seen = stored(result.rounds.withColumn("best", -best["r"]), "seen")
    ends = seen.groupBy("fold").agg(
        F.coalesce(F.min(F.when(F.col("round") - F.col("best") >= PATIENCE, F.col("round"))), F.max("round")).alias("last"),
        (F.max("round") == F.count(F.lit(1))).alias("rounds_are_whole"))
    chosen = ends.join(seen, "fold").where("round = last").select("fold", "rounds_are_whole", F.col("best").alias("round"))
    chosen = chosen.join(seen.select("fold", "round", "auc"), ["fold", "round"])
    kept = spark.createDataFrame(_trees(result), "fold int, trees int, fold_auc double")
    return chosen.join(kept, "fold").select("fold", "rounds_are_whole", (F.col("trees") == F.col("round")).alias("trees_end_at_the_best"),
                                            (F.abs(F.col("auc") - F.col("fold_auc")) < 1e-9).alias("auc_is_that_round_s"))


_RATIO = "CASE WHEN nation <> 0 THEN amount / nation END"


@query(with_p(f"""SELECT c AS "column", CAST(k AS INTEGER) AS fold, round(median(v), 6) AS median
  FROM (SELECT 'ratio' AS c, id, {_RATIO} AS v FROM p UNION ALL SELECT 'balance', id, balance FROM p) x, range(5) f(k)
  WHERE id % 5 <> k AND v IS NOT NULL GROUP BY c, k"""))
def fold_medians(spark, folder):
    """Medians that fill a fold's model: of the values of all other folds, gaps left out."""
    df = frames.orders_frame(spark, folder, ["id", "amount", "nation", "balance"])
    df = stored(df.select((F.col("id") % 5).cast("int").alias("fold"), F.expr(_RATIO).alias("ratio"), "balance"), "gaps")
    return rounded(impute.fold_medians(df, ["ratio", "balance"], "fold"))


@query("SELECT CAST(i AS INTEGER) AS trial, true AS in_space, i = 0 AS is_default, true AS same_again FROM range(12) t(i)")
def guided_search_audit(spark, folder):
    """Points of a search of 12 trials, the last two guided: within the ranges, the first the defaults, and
    the same when the search goes on from a ledger that holds the first half."""
    data = encoded(spark, folder)
    fixed = {"num_boost_round": 1, "num_leaves": 4, "max_depth": 2}
    space = {k: r for k, r in search.SPACE.items() if k not in fixed}
    book = ledger.RunLedger(spark, work_folder(spark, "ledger"))
    search.search(data, 6, space=space, fixed=fixed, ledger=book)
    found = [search.search(data, 12, space=space, fixed=fixed, ledger=b).trials for b in (book, None)]
    default = spark.createDataFrame([(k, float(v)) for k, v in search.default_point(space).items()], "param string, preset double")
    bounds = spark.createDataFrame([(k, float(r.low), float(r.high)) for k, r in space.items()], "param string, low double, high double")
    other = found[1].select("trial", "param", F.col("value").alias("again"))
    both = found[0].join(other, ["trial", "param"]).join(default, "param").join(bounds, "param")
    return both.groupBy("trial").agg(
        F.every(F.col("value").between(F.col("low"), F.col("high"))).alias("in_space"),
        F.every(F.col("value") == F.col("preset")).alias("is_default"), F.every(F.col("value") == F.col("again")).alias("same_again"))


@query(with_p(" UNION ALL ".join(
    [f"SELECT 'auc_{m}' AS metric, round(auc, 6) + 0.0 AS value FROM ({auc_sql(f'(SELECT y, score_{m} AS s FROM p)')}) {m}" for m in "ab"]
    + ["SELECT 'rows', CAST(count(*) AS DOUBLE) FROM p", "SELECT 'scored', CAST(count(*) AS DOUBLE) FROM p",
       "SELECT 'scored_in_range', CAST(count(*) AS DOUBLE) FROM p"])))
def job_stack_report(spark, folder):
    """Two saved models stacked into a template: the exact part of the report, and what was read back."""
    df = stored(frames.orders_frame(spark, folder, ["id", "y", "score_a", "score_b"]), "scores")
    out = work_folder(spark, "stack")
    for name in ("a", "b"):
        files.save_predictions(df, out, name, "id", f"score_{name}")
    saved = {name: files.load_predictions(spark, out, name, "id") for name in ("a", "b")}
    template = df.select("id", F.lit(0.0).alias("y"), F.lit("kept").alias("extra"))
    found, _ = jobs.stack(saved, saved, df, template, "id", "y", "y", out)
    back = files.read_back(spark, f"{out}/scored", template.schema).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("y").between(0, 1) & (F.col("extra") == "kept")).alias("scored_in_range"))
    exact = found.report.where(F.col("metric").isin("rows", "auc_a", "auc_b"))
    return rounded(exact.unionByName(back.select(F.expr(
        "stack(2, 'scored', double(scored), 'scored_in_range', double(scored_in_range)) AS (metric, value)"))))


@query("SELECT s AS setting, f AS features, true AS all_folds, true AS above_chance FROM (VALUES ('base', 17), ('one_hot', 17), "
       "('without_rich', 16), ('crossed', 28)) t(s, f)")
def comparison_audit(spark, folder):
    """Feature sets and encoders on the same folds: columns used, whether all folds were scored, AUC above chance."""
    df = stored(frames.planted_frame(spark, folder), "planted").where("split = 'train'").drop("split")
    few = {"num_boost_round": 3, "num_leaves": 8}
    settings = {"base": jobs.Setting(params=few), "one_hot": jobs.Setting(encoder="onehot", params=few),
                "without_rich": jobs.Setting(without=["rich"], params=few), "crossed": jobs.Setting(spec="v2", params=few)}
    table = jobs.compare(df, "id", "y", settings, frames.ROLES, frames.CATEGORIES)
    return table.groupBy("setting", "features").agg(
        (F.count_if(F.col("metric").startswith("fold_")) == 5).alias("all_folds"),
        F.min(F.when(F.col("metric").endswith("auc"), F.col("value")) > 0.55).alias("above_chance"))


@query("SELECT url, n, CAST(sum(n) OVER (ORDER BY url) AS BIGINT) AS cum_n FROM (SELECT url, count(*) AS n FROM pages WHERE url IS NOT NULL GROUP BY url)")
def running_totals_by_url(spark, folder):
    """Running count of pages in the order of their urls, texts that begin alike."""
    df = frames.table(spark, folder, "pages").select("url", F.lit(1).alias("n"))
    return order.ordered_cumsum(df, "url", ["n"])


@query("""SELECT 'url' AS "column", url AS level, CAST(row_number() OVER (ORDER BY url) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)""")
def vocabulary_of_urls(spark, folder):
    df = frames.table(spark, folder, "pages").select("url")
    return encode.build_vocab(df, df, ["url"])
