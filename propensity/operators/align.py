"""Keyed alignment of tables: predictions to rows, models to models, splits to splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators import checks
from propensity.operators.checks import ContractError


def key_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys missing on either side, repeated on either side, null on either side."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias(name))

    both = side(left, "_l").join(side(right, "_r"), "_k", "full_outer")
    null = F.col("_k").isNull()
    return both.agg(
        F.count_if(F.col("_r").isNull() & ~null).alias("missing"),
        F.count_if(F.col("_l").isNull() & ~null).alias("extra"),
        F.count_if(F.col("_l") > 1).alias("repeated_left"),
        F.count_if(F.col("_r") > 1).alias("repeated_right"),
        F.count_if(null).alias("null_keys"))


def require_same_keys(left: DataFrame, right: DataFrame, key: str, name: str) -> None:
    found = key_report(left, right, key).first().asDict()
    wrong = {k: v for k, v in found.items() if v}
    if wrong:
        raise ContractError(f"{name}: keys do not match, {wrong}")


def attach(df: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    """Predictions onto rows by key; fails unless both sides hold the same keys once."""
    require_same_keys(df, preds, key, "attach")
    return df.join(preds, key)


def align_models(preds: Mapping[str, DataFrame], key: str, value: str = "prediction") -> DataFrame:
    """One column per model. Keys that differ or repeat, and predictions that are not finite, are refused.

    One shuffle of all models' rows in long form. The check is an aggregation of its own, so
    that no later projection can drop it.
    """
    long = None
    for name, frame in preds.items():
        one = frame.select(F.col(key), F.lit(name).alias("_model"), F.col(value).cast("double").alias("_value"))
        long = one if long is None else long.unionByName(one)
    mine = {name: F.col("_model") == name for name in preds}
    finite = F.col("_value").isNotNull() & ~F.isnan("_value") & (F.abs(F.col("_value")) < float("inf"))
    wide = long.groupBy(key).agg(
        *[F.max(F.when(m, F.col("_value"))).alias(name) for name, m in mine.items()],
        *[F.count_if(m).alias(f"_n_{i}") for i, m in enumerate(mine.values())], F.count_if(~finite).alias("_bad"))
    uneven = sum(((F.col(f"_n_{i}") != 1).cast("int") for i in range(len(mine))), F.lit(0))
    found = wide.agg(F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(uneven > 0).alias("missing_or_repeated_keys"),
                     F.count_if(F.col("_bad") > 0).alias("not_finite")).first().asDict()
    wrong = {k: v for k, v in found.items() if v}
    if wrong:
        raise ContractError(f"models do not align: {wrong}")
    return wide.select(key, *preds)


def id_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in both frames."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def id_mismatch(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in one frame only, with the side. Repeated keys merge before the one join."""
    left = a.select(key).distinct().withColumn("_l", F.lit(True))
    right = b.select(key).distinct().withColumn("_r", F.lit(True))
    both = left.join(right, key, "full_outer").where(F.col(key).isNotNull())
    alone = both.where(F.col("_l").isNull() | F.col("_r").isNull())
    return alone.select(key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))


def compare_shares(a: DataFrame, b: DataFrame, col: str, names: tuple[str, str]) -> DataFrame:
    """Share of each level in two groups, 0 where a level is absent."""
    from propensity.operators.profile import value_counts

    left = value_counts(a, col).select(col, F.col("share").alias(names[0]))
    right = value_counts(b, col).select(col, F.col("share").alias(names[1]))
    return left.join(right, col, "full_outer").na.fill(0.0, list(names))


def apply_template(template: DataFrame, preds: DataFrame, key: str, target: str,
                   value: str = "prediction") -> DataFrame:
    """Template with its target column replaced by the predictions of the same key.

    Columns, order, types and further columns of the template stay. Fails on a missing
    target column, on keys that differ or repeat, and on predictions outside [0, 1].
    """
    if target not in template.columns:
        raise ContractError(f"template has no column {target!r}; found {template.columns}")
    checks.require(checks.validate_predictions(preds, value), "predictions")
    require_same_keys(template, preds, key, "template")
    scored = preds.select(key, F.col(value).cast("double").alias("_score"))
    joined = template.join(scored, key, "left")
    return joined.select(*[F.col("_score").alias(c) if c == target else F.col(c) for c in template.columns])


def stack_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both frames, columns matched by name."""
    return a.unionByName(b)
