"""Exact ROC-AUC, average precision and tables built on them.

For one grouping rows are first counted per (group, score), which runs map-side and removes ties. The
ordered part then works on distinct scores, cut into score ranges, so neither a large
group nor a heavily tied score ends up in one task. For many groupings at once rows are dealt by score range.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.operators.order import (
    BUCKET,
    bin_of,
    cut_points,
    edge_table,
    quantile_edges,
    running_totals,
    with_bucket,
)

# Tasks that share the rows of a score which fills a range.
SALTS = 64


def _checked_score(y: str, p: str) -> Column:
    """The score as a double; a label that is not 0 or 1 and a score that is null, NaN or infinite fail the query."""
    score, label = F.col(p).cast("double"), F.col(y).cast("double")
    good = label.isin(0.0, 1.0) & ~F.isnan(score) & (F.abs(score) < float("inf"))
    text = F.concat(F.lit("label or score not usable: "), F.coalesce(F.col(y).cast("string"), F.lit("null")), F.lit(", "),
                    F.coalesce(F.col(p).cast("string"), F.lit("null")))
    return F.when(F.coalesce(good, F.lit(False)), score).otherwise(F.raise_error(text).cast("double"))


def _score_counts(df: DataFrame, y: str, p: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per (by, score). Rows with a null key have no group."""
    keep = F.lit(True)
    for c in by:
        keep = keep & F.col(c).isNotNull()
    return (df.where(keep).groupBy(*by, _checked_score(y, p).alias("_s"))
            .agg(F.sum(F.col(y).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_n"))
            .withColumn("_neg", F.col("_n") - F.col("_pos")))


def _auc_by(counts: DataFrame, by: Sequence[str], cuts: Sequence[float]) -> DataFrame:
    """n, positives, auc per ``by``. Null AUC where a group has a single class."""
    by = list(by)
    keyed = with_bucket(counts, "_s", cuts)
    lower = (Window.partitionBy(*by, BUCKET).orderBy("_s")
             .rowsBetween(Window.unboundedPreceding, -1))
    below = F.coalesce(F.sum("_neg").over(lower), F.lit(0))
    # A positive beats every lower negative and half of the tied ones.
    wins = F.col("_pos").cast("double") * (F.col("_below") + F.col("_neg") / 2)
    parts = (keyed.withColumn("_below", below).groupBy(*by, BUCKET)
             .agg(F.sum(wins).alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg")))
    if cuts:
        prior = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        carried = F.col("_pos").cast("double") * F.coalesce(F.sum("_neg").over(prior), F.lit(0))
        parts = parts.withColumn("_wins", F.col("_wins") + carried)
        parts = parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("_wins", "_pos", "_neg")])
    pairs = F.col("_pos").cast("double") * F.col("_neg")
    return parts.select(*by, (F.col("_pos") + F.col("_neg")).alias("n"), F.col("_pos").alias("positives"),
                        F.when(pairs > 0, F.col("_wins") / pairs).alias("auc"))


def roc_auc(df: DataFrame, y: str, p: str,
            cuts: Sequence[float] | None = None) -> DataFrame:
    """One row ``auc``: chance that a positive outscores a negative, ties half."""
    cuts = cut_points(df, p) if cuts is None else cuts
    return _auc_by(_score_counts(df, y, p, ()), (), cuts).select("n", "positives", "auc")


def grouped_auc(df: DataFrame, by: Sequence[str], y: str, p: str, min_count: int = 0,
                drop_single_class: bool = False,
                cuts: Sequence[float] | None = None) -> DataFrame:
    """Rows, positive rate and AUC per group, null keys left out.

    Single-class groups keep a null AUC, or go when ``drop_single_class``.
    """
    cuts = cut_points(df, p) if cuts is None else cuts
    out = _auc_by(_score_counts(df, y, p, by), by, cuts).where(F.col("n") >= min_count)
    if drop_single_class:
        out = out.where(F.col("auc").isNotNull())
    return out.select(*by, "n", (F.col("positives") / F.col("n")).alias("positive_rate"), "auc")


def average_precision(df: DataFrame, y: str, p: str, by: Sequence[str] = (),
                      cuts: Sequence[float] | None = None) -> DataFrame:
    """Sum of precision times gained recall over distinct scores, highest first.

    Step-wise, not the trapezoid under the precision-recall curve. Null without positives.
    """
    cuts = cut_points(df, p) if cuts is None else cuts
    run = running_totals(_score_counts(df, y, p, by), "_s", ["_pos", "_n"], by, cuts, descending=True)
    gained = F.col("_pos").cast("double") * F.col("cum__pos") / F.col("cum__n")
    return (run.groupBy(*by).agg(F.sum(gained).alias("_gain"), F.sum("_pos").alias("_pos"))
            .select(*by, F.when(F.col("_pos") > 0, F.col("_gain") / F.col("_pos")).alias("average_precision")))


def fold_auc(df: DataFrame, y: str, p: str, fold: str,
             cuts: Sequence[float] | None = None) -> DataFrame:
    """AUC per fold, one row each."""
    return grouped_auc(df, [fold], y, p, cuts=cuts)


def pooled_vs_fold(df: DataFrame, y: str, p: str, fold: str,
                   cuts: Sequence[float] | None = None) -> DataFrame:
    """Pooled AUC beside mean and population deviation of the fold AUCs."""
    cuts = cut_points(df, p) if cuts is None else cuts
    folds = fold_auc(df, y, p, fold, cuts=cuts)
    pooled = roc_auc(df, y, p, cuts=cuts)
    return folds.agg(F.count(F.lit(1)).alias("folds"), F.avg("auc").alias("mean_auc"),
                     F.stddev_pop("auc").alias("std_auc")).withColumn("pooled_auc", pooled.select("auc").scalar())


def _tied_ranges(cuts: Sequence[float]) -> list[int]:
    """Ranges that hold a single score."""
    return [i + 1 for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b == math.nextafter(a, math.inf)]


def _auc_of_values(df: DataFrame, y: str, p: str, values: Sequence[tuple[str, Column]], cuts: Sequence[float]) -> DataFrame:
    """column, value, n, positives, auc, score_sum for every value of many columns.

    Each row is shuffled once, by its range of scores, however many columns there are; inside a range
    it is spread over the columns, counted and passed in order. What then crosses the network has a row per
    range and value. A score that fills a range needs no order, so its rows are dealt over ``SALTS`` tasks.
    """
    rows = df.select(_checked_score(y, p).alias("_s"), F.col(y).cast("long").alias("_y"),
                     F.array(*[F.struct(F.lit(n).alias("column"), v.alias("value")) for n, v in values]).alias("_cells"))
    tied = F.col(BUCKET).isin(_tied_ranges(cuts))
    salt = F.when(tied, F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(F.lit(0))
    dealt = with_bucket(rows, "_s", cuts).withColumn("_salt", salt).repartition(BUCKET, "_salt")
    by = [BUCKET, "_salt", "column", "value"]
    counts = (dealt.select(BUCKET, "_salt", "_s", "_y", F.explode("_cells").alias("_c")).select(BUCKET, "_salt", "_s", "_y", "_c.*")
              .where(F.col("value").isNotNull()).groupBy(*by, "_s").agg(F.sum("_y").alias("_pos"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_neg", F.col("_n") - F.col("_pos")))
    lower = Window.partitionBy(*by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(lower), F.lit(0))
    wins = F.col("_pos").cast("double") * (F.col("_below") + F.col("_neg") / 2)
    parts = counts.withColumn("_below", below).groupBy("column", "value", BUCKET).agg(
        F.sum(wins).alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"), F.sum(F.col("_s") * F.col("_n")).alias("_sum"))
    own = F.when(tied, F.col("_pos").cast("double") * F.col("_neg") / 2).otherwise(F.col("_wins"))
    prior = Window.partitionBy("column", "value").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.col("_pos").cast("double") * F.coalesce(F.sum("_neg").over(prior), F.lit(0))
    whole = parts.withColumn("_wins", own + carried).groupBy("column", "value").agg(
        *[F.sum(c).alias(c) for c in ("_wins", "_pos", "_neg", "_sum")])
    pairs = F.col("_pos").cast("double") * F.col("_neg")
    return whole.select("column", "value", (F.col("_pos") + F.col("_neg")).alias("n"), F.col("_pos").alias("positives"),
                        F.when(pairs > 0, F.col("_wins") / pairs).alias("auc"), F.col("_sum").alias("score_sum"))


def subgroup_auc(df: DataFrame, cols: Sequence[str], y: str, p: str,
                 cuts: Sequence[float] | None = None) -> DataFrame:
    """``grouped_auc`` for each of many columns, stacked as (feature, value, ...)."""
    cuts = cut_points(df, p) if cuts is None else cuts
    found = _auc_of_values(df, y, p, [(c, F.col(c).cast("string")) for c in cols], cuts)
    return found.select(F.col("column").alias("feature"), "value", "n", (F.col("positives") / F.col("n")).alias("positive_rate"), "auc")


def auc_by_quantiles(df: DataFrame, cols: Sequence[str], y: str, p: str, q: int = 10,
                     cuts: Sequence[float] | None = None,
                     edges: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Per quantile bin of many columns: bounds, rows, positive rate, AUC, mean prediction."""
    edges = edges or quantile_edges(df, cols, q)
    cuts = cut_points(df, p) if cuts is None else cuts
    found = _auc_of_values(df, y, p, [(c, bin_of(c, marks)) for c, marks in edges.items()], cuts)
    out = found.withColumnRenamed("value", "bin").join(F.broadcast(edge_table(df, edges)), ["column", "bin"])
    return out.select("column", "bin", "lo", "hi", "n", (F.col("positives") / F.col("n")).alias("positive_rate"),
                      "auc", (F.col("score_sum") / F.col("n")).alias("mean_prediction"))


def auc_by_quantile(df: DataFrame, col: str, y: str, p: str, q: int = 10,
                    cuts: Sequence[float] | None = None) -> DataFrame:
    """Per quantile bin of one column: bounds, rows, positive rate, AUC, mean prediction."""
    return auc_by_quantiles(df, [col], y, p, q, cuts).drop("column")


def conditional_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = (), bins: dict[str, int] | None = None,
                    min_count: int = 500,
                    cuts: Sequence[float] | None = None) -> DataFrame:
    """AUC over groups that mix plain keys with quantile bins (column -> number of bins).

    Groups below ``min_count`` rows or with one class are left out.
    """
    bins = bins or {}
    edges = quantile_edges(df, list(bins), bins) if bins else {}
    keyed = df.withColumns({f"{c}_bin": bin_of(c, edges[c]) for c in bins})
    return grouped_auc(keyed, [*by, *[f"{c}_bin" for c in bins]], y, p, min_count, True, cuts)


def confusion_at(df: DataFrame, y: str, p: str, thresholds: Sequence[float]) -> DataFrame:
    """tp, fp, tn, fn where a score at or above the threshold counts as yes. One scan."""
    hit, pos = [F.col(p) >= F.lit(t) for t in thresholds], F.col(y) == 1

    def cell(i: int, t: float) -> Column:
        return F.struct(F.lit(float(t)).alias("threshold"),
                        F.count_if(hit[i] & pos).alias("tp"), F.count_if(hit[i] & ~pos).alias("fp"),
                        F.count_if(~hit[i] & ~pos).alias("tn"), F.count_if(~hit[i] & pos).alias("fn"))

    cells = F.array(*[cell(i, t) for i, t in enumerate(thresholds)])
    return df.agg(cells.alias("cells")).select(F.inline("cells"))


def constant_baseline(df: DataFrame, y: str) -> DataFrame:
    """The base rate as every prediction, scored: AUC one half, AP the base rate."""
    base = df.where(F.col(y).isNotNull())
    flat = base.select(F.col(y), F.lit(0.0).alias("_p"))
    # One distinct score: the cuts are never needed.
    auc = roc_auc(flat, y, "_p", cuts=[]).select("auc")
    ap = average_precision(flat, y, "_p", cuts=[])
    return base.agg(F.avg(y).alias("base_rate")).select(
        "base_rate", auc.scalar().alias("auc"), ap.scalar().alias("average_precision"))
