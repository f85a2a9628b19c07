"""Folds and samples that depend only on the key and a seed.

Rows are ordered by the md5 of ``seed:key``. The first hex digits of that hash are
uniform buckets, so ranks come from windows inside a bucket plus a small table of
bucket counts: no class, however large, is sorted in one task. The number of digits follows
from the largest class, so a bucket never holds many more than ``BUCKET_ROWS`` rows.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.operators.checks import ContractError
from propensity.operators.order import ordered_cumsum
from propensity.session import stored

# Rows of a bucket, about.
BUCKET_ROWS = 100_000


def key_hash(key: str, seed: int) -> Column:
    """Hash of seed and key, as text. A null key fails the query."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _required(key)))


def digits_for(rows: int) -> int:
    """Hex digits that cut so many rows into buckets of ``BUCKET_ROWS`` or fewer."""
    digits = 0
    while rows > BUCKET_ROWS * 16 ** digits:
        digits += 1
    return digits


def _hashed(df: DataFrame, key: str, y: str | None, seed: int) -> DataFrame:
    counts = df.groupBy(*([] if y is None else [y])).agg(F.count(F.lit(1)).alias("n"))
    digits = digits_for(counts.agg(F.max("n")).first()[0] or 0)
    if y is None:
        group = F.substring(_required(key), 1, 0)
    else:
        group = F.coalesce(F.col(y).cast("string"), F.raise_error(F.lit(f"null class in {y}")).cast("string"))
    return df.withColumns({"_class": group, "_hash": key_hash(key, seed)}).withColumn(
        "_bucket", F.coalesce(F.substring("_hash", 1, digits), F.lit("")))


def _required(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit(f"null key in {key}")).cast("string"))


def stratified_position(df: DataFrame, key: str, y: str | None, seed: int, out: str = "position") -> DataFrame:
    """Append the 0-based place of a row when sorted by class, then hash."""
    keyed = _hashed(df, key, y, seed)
    counts = keyed.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # A row per bucket: some ten for each million rows of a class. Classes are counted through by ranges.
    earlier = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered_cumsum(counts, "_class", ["_n"]).select("_class", (F.col("cum__n") - F.col("_n")).alias("_start"))
    offsets = counts.select("_class", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_in")).join(
        totals, "_class").select("_class", "_bucket", (F.col("_in") + F.col("_start")).alias("_before"))
    inside = Window.partitionBy("_class", "_bucket").orderBy("_hash", key)
    placed = keyed.withColumn("_row", F.row_number().over(inside)).join(offsets, ["_class", "_bucket"])
    return placed.select(*df.columns, (F.col("_before") + F.col("_row") - 1).alias(out))


def stratified_folds(df: DataFrame, key: str, y: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Append a fold 0..k-1: every row in one fold, classes balanced, sizes within one."""
    if k < 2:
        raise ContractError("at least two folds are needed")
    found = df.limit(k).count()
    if found < k:
        raise ContractError(f"{found} rows cannot fill {k} folds")
    placed = stratified_position(df, key, y, seed, "_position")
    return placed.withColumn(out, F.pmod("_position", F.lit(k)).cast("int")).drop("_position")


def fold_audit(df: DataFrame, fold: str, y: str) -> DataFrame:
    """Rows and positive rate per fold."""
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("rows"), F.avg(y).alias("positive_rate"))


def _smallest(df: DataFrame, key: str, y: str | None, seed: int, size: Callable[[Column], Column]) -> DataFrame:
    """Flag ``_taken`` on the ``size(class count)`` rows of lowest hash in every class.

    Bucket counts tell which buckets are wholly in or out; only the rows of one boundary
    bucket per class are ranked, and the cut-off hash is read from them. The
    table of cut-offs has one row per class and stays distributed; where it is small, the join
    with it moves no row of ``df``.
    """
    keyed = _hashed(df, key, y, seed)
    counted = keyed.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_class")
    run = counted.withColumns({"_upto": F.sum("_n").over(upto), "_want": size(F.sum("_n").over(whole))})
    # The bucket in which the wanted count is reached, and how many of its rows are in.
    edges = run.where((F.col("_want") > F.col("_upto") - F.col("_n")) & (F.col("_want") <= F.col("_upto"))).select(
        "_class", F.col("_bucket").alias("_edge"), (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_left"))
    at_edge = keyed.select("_class", "_bucket", "_hash").join(edges, "_class").where(F.col("_bucket") == F.col("_edge"))
    ranked = at_edge.withColumn("_row", F.row_number().over(Window.partitionBy("_class").orderBy("_hash")))
    # Stored, its true size tells the planner whether to broadcast it.
    cut = stored(ranked.where(F.col("_row") == F.col("_left")).select("_class", F.col("_hash").alias("_cut")), "cuts")
    # A class that takes nothing has no cut-off.
    joined = keyed.join(cut, "_class", "left").withColumn("_taken", F.coalesce(F.col("_hash") <= F.col("_cut"), F.lit(False)))
    return joined.select(*df.columns, "_taken")


def _ratio(frac: float, n: Column, add: Fraction = Fraction(0)) -> Column:
    """Whole part of frac x n + add, without float drift."""
    part = Fraction(str(frac))
    below = part.denominator * add.denominator
    above = n.cast("decimal(38,0)") * (part.numerator * add.denominator) + add.numerator * part.denominator
    return ((above - above % below) / below).cast("long")


def _part(frac: float, n: Column) -> Column:
    """frac x n, rounded half up."""
    return _ratio(frac, n, Fraction(1, 2))


def stratified_holdout(df: DataFrame, key: str, y: str, frac: float = 0.2, seed: int = 42,
                       out: str = "holdout") -> DataFrame:
    """Append a flag that marks ``frac`` of every class."""
    return _smallest(df, key, y, seed, lambda n: _part(frac, n)).withColumnRenamed("_taken", out)


def stratified_sample(df: DataFrame, key: str, y: str, frac: float, floor: int = 0, seed: int = 42) -> DataFrame:
    """Exactly max(floor, whole part of frac x n) rows of every class, at most the class."""
    def size(n: Column) -> Column:
        return F.least(n, F.greatest(F.lit(floor).cast("long"), _ratio(frac, n)))

    return _smallest(df, key, y, seed, size).where("_taken").drop("_taken")


def sample_fraction(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    """Exactly round(frac x n) rows."""
    return _smallest(df, key, None, seed, lambda n: _part(frac, n)).where("_taken").drop("_taken")
