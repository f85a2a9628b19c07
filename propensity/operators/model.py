"""K-fold fitting and scoring of tree and logistic models on ``pyspark.ml``.

Rows are encoded once into a feature vector and written as a table partitioned by fold,
so fitting on the other folds is partition pruning and a lost executor costs a re-read,
not a re-encoding.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators import boost, staged
from propensity.operators.encode import build_vocab, level_lists
from propensity.operators.impute import fold_medians, known
from propensity.operators.metrics import fold_auc, roc_auc
from propensity.session import stored, work_folder
from propensity.sources.stages import Stages, content

# Default parameters under their usual booster names.
DEFAULTS: dict[str, float] = {
    "learning_rate": 0.05,
    "num_leaves": 63,
    "max_depth": -1,
    "min_data_in_leaf": 100,
    "feature_fraction": 0.9,
    "bagging_fraction": 0.9,
    "num_boost_round": 2000,
    "seed": 42,
}
# Other booster's names for the same settings.
SAME_AS = {
    "eta": "learning_rate", "n_estimators": "num_boost_round", "num_iterations": "num_boost_round",
    "min_child_weight": "min_data_in_leaf", "subsample": "bagging_fraction",
    "colsample_bytree": "feature_fraction", "random_state": "seed", "max_leaves": "num_leaves",
}
# Settings MLlib trees lack, with the value that means "off".
NO_COUNTERPART = {"lambda_l1": 0, "lambda_l2": 0, "reg_alpha": 0, "reg_lambda": 0, "gamma": 0, "bagging_freq": 0}
# Settings that are fixed here, with the values that name what is in force.
FIXED = {"objective": ("binary", "binary:logistic"), "metric": ("auc",), "eval_metric": ("auc",), "tree_method": ("hist",)}
# Settings that only concern other engines' output.
IGNORED = {"verbose", "verbosity", "n_jobs"}


def merge_params(overrides: Mapping[str, object] | None = None,
                 defaults: Mapping[str, object] = DEFAULTS) -> dict[str, object]:
    """Defaults overlaid by the caller's values, under one set of names."""
    out = dict(defaults)
    for name, value in (overrides or {}).items():
        name = SAME_AS.get(name, name)
        if name in IGNORED:
            continue
        if name in FIXED:
            if value not in FIXED[name]:
                raise ValueError(f"{name}={value!r} is not what the trees are fitted with: {FIXED[name]}")
            continue
        if name in NO_COUNTERPART:
            if value != NO_COUNTERPART[name]:
                raise ValueError(f"{name}={value} has no counterpart in MLlib trees; leave it out")
            continue
        if name not in DEFAULTS and name not in ("max_bin", "checkpoint_interval"):
            raise ValueError(f"unknown parameter {name!r}")
        out[name] = value
    return out


def tree_depth(params: Mapping[str, object]) -> int:
    """Depth that holds the asked number of leaves, within any explicit cap."""
    need = max(1, math.ceil(math.log2(int(params["num_leaves"]))))
    cap = int(params["max_depth"])
    return min(need, cap) if cap > 0 else need


def make_gbt(params: Mapping[str, object], max_bins: int, early_stopping: float | None = None) -> GBTClassifier:
    stop = {} if early_stopping is None else {
        "validationIndicatorCol": "_held", "validationTol": early_stopping}
    return GBTClassifier(
        featuresCol="features", labelCol="label", stepSize=float(params["learning_rate"]),
        maxIter=int(params["num_boost_round"]), maxDepth=tree_depth(params),
        minInstancesPerNode=int(params["min_data_in_leaf"]), subsamplingRate=float(params["bagging_fraction"]),
        featureSubsetStrategy=str(float(params["feature_fraction"])), seed=int(params["seed"]),
        maxBins=max(int(params.get("max_bin", 256)), max_bins),
        checkpointInterval=int(params.get("checkpoint_interval", 10)), **stop)


# --- encoding -------------------------------------------------------------------

@dataclass
class Encoded:
    """Feature vectors of both splits, as tables.

    Numeric columns with missing values stand beside the vector ``base`` as ``gaps``; a fold's model fills
    them with that fold's ``fills`` before its own vector is assembled. Without gaps ``base`` is ``features``.
    """

    train: DataFrame  # key, label, fold, base, gaps
    test: DataFrame | None  # key, base, gaps
    key: str
    names: list[str]
    max_bins: int
    rows: int
    stages: PipelineModel
    base: str = "features"
    gaps: list[str] = field(default_factory=list)
    fills: dict[int, list[float]] = field(default_factory=dict)
    binned: dict[tuple, boost.Binned] = field(default_factory=dict, repr=False)  # what fits with other settings share
    folds: list[int] = field(default_factory=list, repr=False)

    def blocks(self, k: int, bins: int, seed: int, held: bool) -> boost.Binned:
        """Binned rows of all folds but ``k``, and where ``held`` those of ``k`` beside them."""
        key = (k, bins, seed, held)
        if key not in self.binned:
            rest, own = self.train.where(F.col("fold") != k), self.train.where(F.col("fold") == k)
            if self.gaps:
                # Which rows a tree draws depends on their places in tasks. Rows whose gaps are filled have always come
                # from tasks over the files of all folds; so the filter must not prune any.
                rest = self.train.where(F.col("fold") + 0 * F.spark_partition_id() != k)
            self.binned[key] = boost.bin_rows(rest, own if held else None, self.filling(k), self.base, self.gaps,
                                              self.fills.get(k, []), bins, seed)
        return self.binned[key]

    def filling(self, k: int) -> list:
        """Stages that turn base and gaps into the features of fold ``k``'s model."""
        if not self.gaps:
            return []
        filled = [f"_full_{i}" for i in range(len(self.gaps))]
        parts = ", ".join(f"coalesce({g}, DOUBLE({v!r})) AS {f}" for g, v, f in zip(self.gaps, self.fills[k], filled))
        return [SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__"),
                VectorAssembler(inputCols=[self.base, *filled], outputCol="features", handleInvalid="error")]


def _assembler(train: DataFrame, numeric: Sequence[str], gaps: Mapping[str, str], cats: Sequence[str],
               levels: Mapping[str, Sequence[str]], encoder: str, out: str) -> PipelineModel:
    stages, parts = [], list(numeric)
    if gaps:
        flags = {f"_missing{g}": f"`{c}`" for c, g in gaps.items()}
        made = [f"CASE WHEN NOT isnan(DOUBLE(`{c}`)) THEN DOUBLE(`{c}`) END AS {g}" for c, g in gaps.items()]
        made += [f"INT({x} IS NULL OR isnan(DOUBLE({x}))) AS {flag}" for flag, x in flags.items()]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__"))
        parts += list(flags)
    if cats:
        codes = [f"_code_{c}" for c in cats]
        stages += [StringIndexerModel.from_labels(list(levels.get(c, [])), inputCol=c, outputCol=code,
                                                  handleInvalid="keep") for c, code in zip(cats, codes)]
        if encoder == "onehot":
            hot = OneHotEncoder(inputCols=codes, outputCols=[f"_hot_{c}" for c in cats],
                                dropLast=False, handleInvalid="keep")
            # Levels are known from the codes' metadata: fitting reads no rows.
            stages.append(hot.fit(PipelineModel(list(stages)).transform(train)))
            parts += [f"_hot_{c}" for c in cats]
        elif encoder == "codes":
            parts += codes
        else:
            raise ValueError(f"encoder must be codes or onehot, not {encoder!r}")
    stages.append(VectorAssembler(inputCols=parts, outputCol=out, handleInvalid="error"))
    return PipelineModel(stages)


def _with_gaps(frames: Sequence[DataFrame], numeric: Sequence[str]) -> list[str]:
    """Numeric columns in which a frame has a missing value."""
    found = set()
    for df in frames:
        row = df.agg(*[F.max(known(c).isNull()).alias(str(i)) for i, c in enumerate(numeric)]).first() if numeric else []
        found |= {c for c, missing in zip(numeric, row) if missing}
    return [c for c in numeric if c in found]


def encode_frames(train: DataFrame, test: DataFrame | None, key: str, y: str, fold: str,
                  features: Sequence[str], cats: Sequence[str] = (), encoder: str = "codes") -> Encoded:
    """Encode both splits once. Category levels come from both, never from the target.

    A numeric column with missing values gets a flag, and each fold's model fills it with the median of
    the rows it is fitted on (0 where those have no value).
    """
    spark = train.sparkSession
    cats = [c for c in cats if c in features]
    numeric = [c for c in features if c not in cats]
    levels = level_lists(build_vocab(train, test if test is not None else train, cats)) if cats else {}
    open_ = _with_gaps([train] if test is None else [train, test], numeric)
    gaps = {c: f"_gap_{i}" for i, c in enumerate(open_)}
    full = [c for c in numeric if c not in gaps]
    base = "_base" if gaps else "features"
    stages = _assembler(train, full, gaps, cats, levels, encoder, base)

    folder = work_folder(spark, "features")
    kept = [base, *gaps.values()]
    (stages.transform(train).select(key, F.col(y).cast("double").alias("label"), F.col(fold).alias("fold"), *kept)
     .write.partitionBy("fold").parquet(f"{folder}/train"))
    encoded = spark.read.parquet(f"{folder}/train")
    scored = None
    if test is not None:
        stages.transform(test).select(key, *kept).write.parquet(f"{folder}/test")
        scored = spark.read.parquet(f"{folder}/test")
    widest = max((len(v) for v in levels.values()), default=0) + 1
    bins = widest if encoder == "codes" else 2
    fills: dict[int, list[float]] = {}
    if gaps:
        found = {(r["column"], r["fold"]): r["median"] for r in fold_medians(train, list(gaps), fold).collect()}
        for k in sorted({k for _, k in found}):
            fills[k] = [0.0 if found[(c, k)] is None else found[(c, k)] for c in gaps]
    names = [*full, *cats, *gaps]
    # The count is read from the written table's footers.
    return Encoded(encoded, scored, key, names, bins, encoded.count(), stages, base, list(gaps.values()), fills)


# --- fitting --------------------------------------------------------------------

@dataclass
class CvResult:
    models: dict[int, Model]
    oof: DataFrame  # key, fold, label, prediction
    test: DataFrame | None  # key, prediction
    fold_aucs: list[float]
    data: Encoded
    params: dict[str, object] = field(default_factory=dict)
    rounds: DataFrame | None = None  # fold, round, auc of every round fitted with patience

    @property
    def mean(self) -> float:
        return sum(self.fold_aucs) / len(self.fold_aucs)

    @property
    def std(self) -> float:
        return math.sqrt(sum((a - self.mean) ** 2 for a in self.fold_aucs) / len(self.fold_aucs))

    def metrics(self) -> dict[str, float]:
        named = {f"fold_{k}_auc": a for k, a in zip(sorted(self.models), self.fold_aucs)}
        return {**named, "cv_auc_mean": self.mean, "cv_auc_std": self.std}


def parts(model: Model) -> tuple[list, Model]:
    """The stages that make a fold's features (none where its numbers have no gaps), and what was fitted on them."""
    *before, last = model.stages if isinstance(model, PipelineModel) else [model]
    return before, last


def probability(df: DataFrame, model: Model, out: str) -> DataFrame:
    """Append the chance of class 1. A pipeline's first stages make the features, which do not stay."""
    before, last = parts(model)
    given = PipelineModel(before).transform(df) if before else df
    scored = last.copy().setProbabilityCol("_prob").setRawPredictionCol("").setPredictionCol("").transform(given)
    return scored.select(*df.columns, vector_to_array("_prob")[1].alias(out))


def score(df: DataFrame, models: Sequence[Model], out: str = "prediction") -> DataFrame:
    """Mean chance of class 1 over the models, for rows that carry encoded columns.

    A row-wise map: also legal on a streaming frame.
    """
    scored = df
    for i, model in enumerate(models):
        scored = probability(scored, model, f"_m{i}")
    mean = sum((F.col(f"_m{i}") for i in range(len(models))), F.lit(0.0)) / len(models)
    return scored.select(*df.columns, mean.alias(out))


def _estimator(kind: str, params: Mapping[str, object], data: Encoded, early_stopping: float | None):
    if kind == "gbt":
        return make_gbt(params, data.max_bins, early_stopping)
    if kind == "logistic":
        # A unit L2 penalty on the summed loss; MLlib's is set against the mean loss.
        return LogisticRegression(featuresCol="features", labelCol="label", maxIter=100, tol=1e-4,
                                  regParam=1.0 / max(1, data.rows))
    raise ValueError(f"estimator must be gbt or logistic, not {kind!r}")


def fold_ids(data: Encoded) -> list[int]:
    data.folds = data.folds or sorted(r["fold"] for r in data.train.select("fold").distinct().collect())
    return data.folds


def fit_fold(data: Encoded, k: int, params: Mapping[str, object], kind: str = "gbt",
             early_stopping: float | None = None) -> Model:
    """Fit on every fold but ``k``. With a tolerance, the loss on fold ``k`` decides when to stop."""
    estimator = _estimator(kind, params, data, early_stopping)
    filling = data.filling(k)
    if kind == "gbt" and data.rows > boost.LEAST_ROWS:
        held = data.train.where(F.col("fold") == k).count() if early_stopping is not None else 0
        binned = data.blocks(k, estimator.getMaxBins(), estimator.getSeed(), early_stopping is not None)
        fitted = boost.fit_trees(binned, estimator, data.train.sparkSession, early_stopping, held)
    else:
        rows = PipelineModel(filling).transform(data.train) if filling else data.train
        if early_stopping is not None and kind == "gbt":
            fitted = estimator.fit(rows.withColumn("_held", F.col("fold") == k))
        else:
            fitted = estimator.fit(rows.where(F.col("fold") != k))
    return PipelineModel([*filling, fitted]) if filling else fitted


def fit_patient(data: Encoded, k: int, params: Mapping[str, object], patience: int) -> tuple[Model, DataFrame]:
    """The model of fold ``k`` cut to its best round, and (fold, round, auc) of every round fitted.

    Rounds end where fold ``k``'s AUC has not risen for ``patience`` of them, or at ``num_boost_round``. Trees do not
    depend on how many follow, so they are fitted in lots that double until the end lies within: at most
    twice the trees that are needed, never all of a long budget.
    """
    most = int(params["num_boost_round"])
    rounds = min(most, max(2 * patience, 16))
    held = data.train.where(F.col("fold") == k)
    while True:
        fitted = fit_fold(data, k, {**params, "num_boost_round": rounds})
        filling, trees = parts(fitted)
        seen = PipelineModel(filling).transform(held) if filling else held
        scores = stored(staged.margins(seen, trees, "label"), "rounds")
        table = stored(staged.round_auc(scores).select(F.lit(k).alias("fold"), "round", "auc"), "round_auc")
        best, ended = staged.best_round([r["auc"] for r in table.orderBy("round").collect()], patience)
        if ended or rounds >= most:
            cut = staged.first_trees(trees, best)
            return (PipelineModel([*filling, cut]) if filling else cut), table
        rounds = min(most, 2 * rounds)


def out_of_fold(data: Encoded, models: Mapping[int, Model]) -> DataFrame:
    """Each row scored by the model that did not see it."""
    out = None
    for k, model in models.items():
        part = probability(data.train.where(F.col("fold") == k), model, "prediction").drop(data.base, *data.gaps)
        out = part if out is None else out.unionByName(part)
    return out


def fit_encoded(data: Encoded, params: Mapping[str, object] | None = None, kind: str = "gbt",
                early_stopping: float | None = None, parallelism: int = 8, patience: int | None = None,
                stages: Stages | None = None) -> CvResult:
    """K fits, submitted together so that small stages of one fill gaps of another.

    ``patience`` ends a fold's trees after so many rounds without a higher AUC on it and keeps the best.
    With ``stages`` each fold's model is kept there as soon as it is fitted, and not fitted again
    from the same rows with the same settings.
    """
    if patience is not None and (kind != "gbt" or early_stopping is not None):
        raise ValueError("patience is for trees, and excludes a tolerance of the loss")
    merged = merge_params(params)
    spark = data.train.sparkSession
    ks = fold_ids(data)

    made_from: dict[str, object] = {}
    if stages is not None:
        made_from = {"data": content(data.train, data.key, "label", "fold", vector_to_array(data.base), *data.gaps), "names": data.names,
                     "fills": data.fills, "params": merged, "kind": kind, "tolerance": early_stopping, "patience": patience}

    def fit(k: int) -> tuple[Model, DataFrame | None]:
        if patience is not None:
            return fit_patient(data, k, merged, patience)
        return fit_fold(data, k, merged, kind, early_stopping), None

    def one(k: int) -> tuple[Model, DataFrame | None]:
        if stages is None:
            return fit(k)
        fitted: list[tuple[Model, DataFrame | None]] = []

        def fresh() -> tuple[Model, DataFrame | None]:
            fitted[:] = fitted or [fit(k)]
            return fitted[0]
        key = {**made_from, "fold": k}
        # The table first: the model's manifest says that both are whole.
        table = None if patience is None else stages.table(f"rounds-{k}", key, lambda: fresh()[1])
        return stages.model(f"model-{k}", key, lambda: fresh()[0]), table

    pool = ThreadPool(min(parallelism, len(ks)))
    try:
        fitted = dict(zip(ks, pool.map(inheritable_thread_target(spark)(one), ks)))
    finally:
        pool.close()
    models = {k: m for k, (m, _) in fitted.items()}
    rounds = None
    for _, table in fitted.values():
        if table is not None:
            rounds = table if rounds is None else rounds.unionByName(table)
    # Scores are kept as a table: every later reading would run all models again.
    oof = stored(out_of_fold(data, models), "oof")
    found = fold_auc(oof, "label", "prediction", "fold")
    aucs = {r["fold"]: r["auc"] for r in found.collect()}
    test = None if data.test is None else score(data.test, list(models.values())).drop(data.base, *data.gaps)
    return CvResult(models, oof, test, [aucs[k] for k in ks], data, merged, rounds)


def cross_val_fit(train: DataFrame, test: DataFrame | None, key: str, y: str, fold: str, features: Sequence[str],
                  cats: Sequence[str] = (), params: Mapping[str, object] | None = None, encoder: str = "codes",
                  kind: str = "gbt", early_stopping: float | None = None, parallelism: int = 8,
                  patience: int | None = None, stages: Stages | None = None) -> CvResult:
    """Out-of-fold scores of ``train``, mean scores of ``test``, AUC per fold."""
    data = encode_frames(train, test, key, y, fold, features, cats, encoder)
    return fit_encoded(data, params, kind, early_stopping, parallelism, patience, stages)


def fold_report(result: CvResult) -> DataFrame:
    """Rows (metric, value): fold AUCs, mean, deviation and pooled AUC."""
    pooled = roc_auc(result.oof, "label", "prediction").first()["auc"]
    rows = [*result.metrics().items(), ("pooled_auc", pooled)]
    return result.oof.sparkSession.createDataFrame([(k, float(v)) for k, v in rows], "metric string, value double")
