"""Medians for filling gaps, for all folds at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators.order import ordered_cumsum


def known(col: str):
    """The number in a column, null where it is missing (null or NaN)."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def fold_medians(df: DataFrame, cols: Sequence[str], fold: str) -> DataFrame:
    """(column, fold, median): for every fold the exact median of the values of all other folds.

    Values are counted once, per fold and distinct value; what a fold's complement holds follows
    by subtraction. Missing values do not count; the median is null where no other fold has a value.
    """
    ks = sorted(r[0] for r in df.select(fold).where(F.col(fold).isNotNull()).distinct().collect())
    counts = [f"n{i}" for i in range(len(ks))]
    numbers = df.select(F.col(fold).alias("_fold"), *[known(c).alias(c) for c in cols])
    long = numbers.unpivot(["_fold"], list(cols), "column", "value").where(F.col("value").isNotNull())
    each = long.select("column", "value", *[(F.col("_fold") == k).cast("long").alias(n) for k, n in zip(ks, counts)])
    run = ordered_cumsum(each, "value", counts, by=["column"])
    totals = each.groupBy("column").agg(*[F.sum(n).alias(f"all_{n}") for n in counts])
    run = run.join(totals, "column")  # one row per column

    def others(prefix: str, mine: str):
        return sum((F.col(f"{prefix}{n}") for n in counts if n != mine), F.lit(0))

    found = []
    for n in counts:
        size, upto, here = others("all_", n), others("cum_", n), others("", n)
        at = [F.floor((size - 1) / 2), F.ceil((size - 1) / 2)]
        hits = [F.max(F.when((upto - here <= i) & (i < upto), F.col("value"))) for i in at]
        found.append(((hits[0] + hits[1]) / 2).alias(f"m_{n}"))
    wide = run.groupBy("column").agg(*found)
    names = df.sparkSession.createDataFrame([(c, k) for c in cols for k in ks], "column string, fold int")
    tall = wide.select("column", F.explode(F.array(*[
        F.struct(F.lit(k).cast("int").alias("fold"), F.col(f"m_{n}").alias("median")) for k, n in zip(ks, counts)])).alias("m"))
    return names.join(tall.select("column", "m.fold", "m.median"), ["column", "fold"], "left")
