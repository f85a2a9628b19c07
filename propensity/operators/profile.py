"""Integrity and distribution profile of a table, each report from one aggregation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.operators.order import quantiles_and

# Rows that are multiplied at once.
BLOCK = 4096


def _stack(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """One aggregation whose structs become rows."""
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def shape_types(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type; row and column counts repeated."""
    cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"),
                      F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))
             for i, (c, t) in enumerate(df.dtypes)]
    return _stack(df, cells)


def _absent(df: DataFrame, col: str) -> Column:
    x = F.col(col)
    return x.isNull() | F.isnan(x) if dict(df.dtypes)[col] in ("double", "float") else x.isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """Null or NaN values per column; the row named ``(total)`` sums them."""
    counts = {c: F.count_if(_absent(df, c)) for c in df.columns}
    total = sum(counts.values(), F.lit(0).cast("long"))
    cells = [F.struct(F.lit(c).alias("column"), n.alias("missing")) for c, n in counts.items()]
    return _stack(df, [*cells, F.struct(F.lit("(total)").alias("column"), total.alias("missing"))])


def is_unique(df: DataFrame, col: str) -> DataFrame:
    """Rows, distinct values and whether no value repeats."""
    return (df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(col).alias("distinct"),
                   F.count_if(F.col(col).isNull()).alias("_null"))
            .select("rows", "distinct",
                    (F.col("rows") == F.col("distinct") + F.least("_null", F.lit(1))).alias("unique")))


def duplicate_rows(df: DataFrame, exclude: Sequence[str] = (), digest: Sequence[str] = ()) -> DataFrame:
    """How many rows repeat an earlier one; nulls equal each other. Copies merge map-side.

    Long texts named in ``digest`` are compared by their SHA-256, so that the shuffle
    moves 64 characters instead of whole texts.
    """
    keys = [F.sha2(c, 256).alias(c) if c in digest else F.col(c) for c in df.columns if c not in exclude]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share of every non-null value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def distinct_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, exact.

    Values are made distinct per column before counting, so no column needs its own pass.
    """
    kinds = dict(df.dtypes)
    # Adding zero makes -0.0 and 0.0 one value.
    values = [F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c) for c in cols]
    texts = df.select(*[v.cast("string").alias(c) for c, v in zip(cols, values)])
    levels = texts.unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull()).distinct()
    found = levels.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return (every.join(found, "column", "left")
            .select("column", F.coalesce("distinct", F.lit(0)).alias("distinct")))


def distinct_levels(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max: one row per column, from two scans."""
    more = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        parts = [F.count(c), F.avg(x), F.when(F.count(c) > 1, F.stddev_samp(x)), F.min(x), F.max(x)]
        more += [p.alias(f"_m{i}_{k}") for k, p in enumerate(parts)]
    found, row = quantiles_and(df, cols, [0.25, 0.5, 0.75], *more)
    rows = []
    for i, c in enumerate(cols):
        n, mean, std, least, most = (row[f"_m{i}_{k}"] for k in range(5))
        rows.append((c, n, mean, std, least, *(found[c] or [None] * 3), most))
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def prediction_stats(df: DataFrame, col: str) -> DataFrame:
    """min, max, mean, median and population deviation of a prediction column, from two scans."""
    x = F.col(col).cast("double")
    found, row = quantiles_and(df, [col], [0.5], F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                               F.stddev_pop(x).alias("std"))
    values = (row["min"], row["max"], row["mean"], (found[col] or [None])[0], row["std"])
    return df.sparkSession.createDataFrame([values], "min double, max double, mean double, median double, std double")


def level_consistency(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: do both splits have the same levels, and how many are on one side only.

    Levels are compared as rows, so a column with very many levels stays distributed.
    """
    def levels(df: DataFrame, side: str) -> DataFrame:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        return (texts.unpivot([], list(cols), "column", "level").where(F.col("level").isNotNull())
                .withColumns({"_train": F.lit(side == "train"), "_test": F.lit(side == "test")}))

    seen = (levels(train, "train").unionByName(levels(test, "test")).groupBy("column", "level")
            .agg(F.max("_train").alias("_train"), F.max("_test").alias("_test")))
    only_train, only_test = F.count_if(~F.col("_test")), F.count_if(~F.col("_train"))
    return seen.groupBy("column").agg(
        F.count(F.lit(1)).alias("levels"), only_train.alias("train_only"), only_test.alias("test_only"),
        (only_train + only_test == 0).alias("same"))


def _class_shares(df: DataFrame, by: Sequence[str], target: str, classes: Sequence[object]) -> DataFrame:
    known = df.where(F.col(target).isin(list(classes)))
    counts = known.groupBy(*by).agg(
        *[F.count_if(F.col(target) == F.lit(k)).alias(f"n_{k}") for k in classes])
    total = sum((F.col(f"n_{k}") for k in classes), F.lit(0))
    return counts.withColumns({f"pct_{k}": F.col(f"n_{k}") / total * 100 for k in classes})


def crosstab_share(df: DataFrame, col: str, target: str, classes: Sequence[object]) -> DataFrame:
    """Per level: count and percentage of each target class."""
    return _class_shares(df.where(F.col(col).isNotNull()), [col], target, classes)


def crosstab_shares(df: DataFrame, cols: Sequence[str], target: str, classes: Sequence[object]) -> DataFrame:
    """``crosstab_share`` of many columns, stacked as (feature, value, ...): one scan."""
    texts = df.select(target, *[F.col(c).cast("string").alias(c) for c in cols])
    long = texts.unpivot([target], list(cols), "feature", "value").where(F.col("value").isNotNull())
    return _class_shares(long, ["feature", "value"], target, classes)


def class_means(df: DataFrame, cols: Sequence[str], target: str, no: object = "No", yes: object = "Yes") -> DataFrame:
    """Per column: mean in either class and the difference in percent of the first, to 2 places."""
    def cell(c: str) -> Column:
        low = F.avg(F.when(F.col(target) == F.lit(no), F.col(c)))
        high = F.avg(F.when(F.col(target) == F.lit(yes), F.col(c)))
        return F.struct(F.lit(c).alias("column"), low.alias("no_mean"), high.alias("yes_mean"))

    wide = _stack(df, [cell(c) for c in cols])
    return wide.withColumn("diff_pct", F.round(
        F.try_divide(F.col("yes_mean") - F.col("no_mean"), F.col("no_mean")) * 100, 2))


def group_means(a: DataFrame, b: DataFrame, cols: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Means of the same columns in two frames, side by side."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return _stack(df, [F.struct(F.lit(c).alias("column"), F.avg(c).alias(f"{name}_mean")) for c in cols])

    return side(a, names[0]).join(side(b, names[1]), "column")


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest value, per class when ``by`` is given.

    Bin number, bounds, count and density; the last bin is closed on the right. Empty
    bins have no row. One value only: the range is widened by half a unit on each side.
    """
    keys = [by] if by else []
    x = F.col(col).cast("double")
    known = df.where(x.isNotNull() & (F.col(by).isNotNull() if by else F.lit(True)))
    ranges = known.groupBy(*keys).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(x).alias("_total"))
    # The rows are read twice but only (class, bin) counts are shuffled.
    if by:
        ends = known.join(ranges, keys)
    else:
        one = ranges.first()
        ends = known.withColumns({k: F.lit(one[k]) for k in ("_lo", "_hi", "_total")})
    flat = F.col("_lo") == F.col("_hi")
    ends = ends.withColumns({"_lo": F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")),
                             "_hi": F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi"))})
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    found = (ends.withColumns({"bin": place, "_w": width}).groupBy(*keys, "bin")
             .agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"),
                  F.first("_w").alias("_w"), F.first("_total").alias("_total")))
    return found.select(*keys, "bin", (F.col("_lo") + F.col("_w") * F.col("bin")).alias("lo"),
                        (F.col("_lo") + F.col("_w") * (F.col("bin") + 1)).alias("hi"), "count",
                        (F.col("count") / F.col("_total") / F.col("_w")).alias("density"))


def _merge(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Counts, means and centred sums of two sets of rows together, for every pair of columns."""
    (n, x, xx, xy), (m, z, zz, zw) = a, b
    both = n + m
    part = np.divide(m, both, out=np.zeros_like(both), where=both > 0)
    gap = np.where((n > 0) & (m > 0), z - x, 0.0)
    return (both, np.where(n > 0, x + gap * part, z), xx + zz + gap * gap * n * part, xy + zw + gap * gap.T * n * part)


def _moments(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every pair (a, b) of columns over the rows where both are known: rows, mean of a, its squared
    deviations, and the products with b's deviations."""
    known = ~np.isnan(x)
    mask = known.astype(np.float64)
    centre = np.divide(np.where(known, x, 0.0).sum(0), mask.sum(0), out=np.zeros(x.shape[1]), where=mask.sum(0) > 0)
    low, high = np.where(known, x, np.inf).min(0), np.where(known, x, -np.inf).max(0)
    centre = np.where(low == high, low, centre)  # a value that never changes has no deviation, not even a rounded one
    y = np.where(known, x - centre, 0.0)
    n, total = mask.T @ mask, y.T @ mask
    mean = np.divide(total, n, out=np.zeros_like(n), where=n > 0)
    return n, centre[:, None] + mean, (y * y).T @ mask - mean * total, y.T @ y - mean * total.T


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are known, long form.

    One scan. Each task adds up blocks of rows as matrices, for all pairs at once; what is shuffled is one row
    for each task and pair, however many rows there are. NaN counts as missing; null where a column does
    not vary or fewer than two rows are known.
    """
    width = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(width)])
            for at in range(0, len(x), BLOCK):
                part = _moments(x[at:at + BLOCK])
                total = part if total is None else _merge(total, part)
        if total is not None:
            i, j = np.triu_indices(width)
            n, mean, square, product = total
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
                i.astype(np.int32), j.astype(np.int32), n[i, j], mean[i, j], mean[j, i], square[i, j], square[j, i], product[i, j])],
                ["i", "j", "n", "mx", "mz", "xx", "zz", "xz"])

    numbers = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    parts = numbers.mapInArrow(run, "i int, j int, n double, mx double, mz double, xx double, zz double, xz double").where("n > 0")
    pair = Window.partitionBy("i", "j")

    def gap(mean: str) -> Column:
        whole = F.sum(F.col("n") * F.col(mean)).over(pair) / F.sum("n").over(pair)
        return F.when(F.min(mean).over(pair) == F.max(mean).over(pair), 0.0).otherwise(F.col(mean) - whole)
    spread = parts.withColumns({"dx": gap("mx"), "dz": gap("mz")})
    sums = spread.groupBy("i", "j").agg(
        F.sum(F.col("xx") + F.col("n") * F.col("dx") * F.col("dx")).alias("xx"),
        F.sum(F.col("zz") + F.col("n") * F.col("dz") * F.col("dz")).alias("zz"),
        F.sum(F.col("xz") + F.col("n") * F.col("dx") * F.col("dz")).alias("xz"))
    found = sums.select("i", "j", F.try_divide("xz", F.sqrt("xx") * F.sqrt("zz")).alias("corr"))
    sides = [(i, j, x, z) for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j for x, z in {(a, b), (b, a)}]
    # One row per cell of the matrix.
    names = df.sparkSession.createDataFrame(sides, "i int, j int, a string, b string")
    return names.join(found, ["i", "j"], "left").select("a", "b", "corr")


def corr_wide(long: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Square view of ``corr_matrix``, rounded."""
    return long.groupBy("a").agg(
        *[F.round(F.max(F.when(F.col("b") == c, F.col("corr"))), digits).alias(c) for c in cols])


def corr_with_target(df: DataFrame, exprs: dict[str, Column], y: str) -> DataFrame:
    """Correlation of derived columns with the target, from one aggregation."""
    wide = df.select(F.col(y).cast("double").alias("_y"), *[e.cast("double").alias(n) for n, e in exprs.items()])
    return _stack(wide, [F.struct(F.lit(n).alias("feature"), F.corr(F.col(n), F.col("_y")).alias("corr"))
                         for n in exprs])
