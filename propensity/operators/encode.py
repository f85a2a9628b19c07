"""Category vocabularies, integer codes and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators.checks import ContractError
from propensity.operators.order import ordered_cumsum

# Levels that ``level_lists`` reads to the driver, and columns that ``one_hot`` makes, unless told otherwise.
MAX_LEVELS = 100_000
MAX_ONE_HOT = 5000


def build_vocab(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, code): levels of both splits, coded alphabetically per column.

    Columns absent from either split are skipped. The target plays no part.
    """
    shared = [c for c in cols if c in train.columns and c in test.columns]
    if not shared:
        return train.sparkSession.createDataFrame([], "column string, level string, code int")

    def levels(df: DataFrame) -> DataFrame:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in shared])
        return texts.unpivot([], shared, "column", "level").where(F.col("level").isNotNull())

    # Equal levels merge map-side, so only the vocabulary itself is shuffled.
    both = levels(train).unionByName(levels(test)).distinct().withColumn("n", F.lit(1))
    # Counted through by ranges of levels: a column of very many levels is not one task.
    placed = ordered_cumsum(both, "level", ["n"], by=["column"])
    return placed.select("column", "level", (F.col("cum_n") - 1).cast("int").alias("code"))


def encode_codes(df: DataFrame, vocab: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Levels to codes; unseen levels and nulls give null."""
    out = df
    for c in cols:
        mine = vocab.where(F.col("column") == c).select(F.col("level").alias("_level"), F.col("code").alias("_code"))
        joined = out.join(mine, F.col(c).cast("string") == F.col("_level"), "left").drop("_level")
        out = joined.withColumn(f"{c}{suffix}", F.col("_code")).drop("_code")
    order = [*df.columns, *[f"{c}{suffix}" for c in cols if f"{c}{suffix}" not in df.columns]]
    return out.select(*order)


def level_lists(vocab: DataFrame, limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Levels per column in code order, for uses that hold them on the driver: names of one-hot
    columns, category codes of a tree. More than ``limit`` of them are refused, never cut."""
    rows = vocab.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ContractError(f"more than {limit} levels in all: raise the limit, or encode the widest columns by encode_codes")
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["column"], r["code"])):
        out.setdefault(r["column"], []).append(r["level"])
    return out


def one_hot(df: DataFrame, vocab: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
            limit: int = MAX_ONE_HOT) -> DataFrame:
    """``keep`` columns, then a 0/1 column ``<col>_<level>`` per level: one projection."""
    levels = level_lists(vocab, limit)
    bits = [F.coalesce((F.col(c).cast("string") == level).cast("int"), F.lit(0)).alias(f"{c}_{level}")
            for c in cols for level in levels.get(c, [])]
    return df.select(*keep, *bits)


def one_hot_vector(df: DataFrame, vocab: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """``keep`` columns and a sparse 0/1 vector over the levels of all columns, for any number of levels.

    Columns follow each other in order, their levels by code; each column ends with a slot for null and
    unseen levels. Codes come from joins, and the driver learns only how many levels a column has.
    """
    sizes = {r["column"]: r["n"] for r in vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    codes = [f"_code_{i}" for i in range(len(cols))]
    coded = encode_codes(df.select(*keep, *cols), vocab, cols, "_code").select(*keep, *[
        F.coalesce(F.col(f"{c}_code"), F.lit(sizes.get(c, 0))).cast("double").alias(code) for c, code in zip(cols, codes)])
    widths = df.sparkSession.createDataFrame([[float(sizes.get(c, 0)) for c in cols]], ", ".join(f"{c} double" for c in codes))
    hot = OneHotEncoder(inputCols=codes, outputCols=[f"_hot{c}" for c in codes], dropLast=False).fit(widths)
    assembled = VectorAssembler(inputCols=hot.getOutputCols(), outputCol=out).transform(hot.transform(coded))
    return assembled.select(*keep, out)
