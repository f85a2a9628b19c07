"""Contracts, target encoding and validators.

A validator returns one row per rule (``rule``, ``bad``, ``ok``) from a single
aggregation; ``require`` turns a failed report into an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as fx


class ContractError(ValueError):
    """Data or schema breaks a declared rule."""


def check_columns(df: DataFrame, expected: Iterable[str], name: str = "table") -> DataFrame:
    """Pass ``df`` through if its column set equals ``expected``. Starts no job."""
    have, want = set(df.columns), set(expected)
    if have != want:
        raise ContractError(
            f"{name}: columns differ, missing {sorted(want - have)}, unexpected {sorted(have - want)}")
    return df


def column_parity(train: DataFrame, test: DataFrame, key: str, target: str) -> list[str]:
    """Feature names shared by both frames in the same order, or an error."""
    if target not in train.columns:
        raise ContractError(f"target {target!r} is not in the training frame")
    if target in test.columns:
        raise ContractError(f"target {target!r} must not be in the test frame")
    ours = [c for c in train.columns if c not in (key, target)]
    theirs = [c for c in test.columns if c != key]
    if ours != theirs:
        raise ContractError(
            f"features differ: only train {sorted(set(ours) - set(theirs))}, "
            f"only test {sorted(set(theirs) - set(ours))}, same order {sorted(ours) == sorted(theirs)}")
    return ours


def encode_target(df: DataFrame, col: str, mapping: Mapping[str, int] = fx.YES_NO,
                  strict: bool = True, out: str | None = None) -> DataFrame:
    """Target text to 0/1. Values outside the mapping fail when the rows are read."""
    code = fx.target_strict(col, mapping) if strict else fx.target_lenient(col)
    return df.withColumn(out or col, code)


def bad_targets(df: DataFrame, col: str, mapping: Mapping[str, int] = fx.YES_NO) -> DataFrame:
    """The target values that ``encode_target`` would refuse, with their counts."""
    known = F.col(col).isin(list(mapping))
    return (df.where(~F.coalesce(known, F.lit(False))).groupBy(col)
            .agg(F.count(F.lit(1)).alias("count")))


def coerce_integral(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Float or decimal columns of whole numbers to long; other columns stay."""
    kinds = dict(df.dtypes)
    todo = {c: fx.integral(c) for c in cols
            if kinds[c] in ("double", "float") or kinds[c].startswith("decimal")}
    return df.withColumns(todo) if todo else df


def _report(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    names = list(measures)
    one = df.agg(*[m.cast("long").alias(n) for n, m in measures.items()])
    return (one.unpivot([], names, "rule", "bad")
            .withColumn("ok", F.col("bad") == 0))


def validate_raw(df: DataFrame, key: str, target: str | None = None) -> DataFrame:
    """Key present, never null and unique; frame not empty; target present when named."""
    for name in filter(None, (key, target)):
        if name not in df.columns:
            raise ContractError(f"column {name!r} is missing; found {df.columns}")
    return _report(df, {
        "empty": (F.count(F.lit(1)) == 0).cast("int"),
        "null_key": F.count(F.lit(1)) - F.count(key),
        "repeated_key": F.count(key) - F.countDistinct(key),
    })


def validate_binary(df: DataFrame, col: str) -> DataFrame:
    """Values are finite and only 0 or 1."""
    x = F.col(col).cast("double")
    is_class = F.coalesce(x.isin(0.0, 1.0), F.lit(False))
    return _report(df, {
        "not_finite": F.count_if(~fx.finite(col)),
        "not_binary": F.count_if(fx.finite(col) & ~is_class),
    })


def validate_predictions(df: DataFrame, col: str) -> DataFrame:
    """Values are finite and within [0, 1]. Call before writing anything."""
    x = F.col(col).cast("double")
    return _report(df, {
        "missing": F.count_if(x.isNull()),
        "not_finite": F.count_if(x.isNotNull() & ~fx.finite(col)),
        "out_of_range": F.count_if(fx.finite(col) & ((x < 0) | (x > 1))),
    })


def require(report: DataFrame, name: str = "table") -> None:
    """Raise when any rule of a validator report failed."""
    failed = [r for r in report.collect() if not r["ok"]]
    if failed:
        raise ContractError(f"{name}: " + ", ".join(f"{r['rule']}={r['bad']}" for r in failed))
