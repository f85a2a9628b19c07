"""Target rates over one, two and three columns, from few scans.

Every family of column subsets comes from one grouping of the rows by few fine blocks of
columns; the subsets are counted from those groups, so that neither rows nor subsets multiply.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.operators.order import edge_table, quantile_edges, unpivot_bins

# Columns that are grouped together whatever their levels; groups that a block of more columns is expected to have at most.
FEW = 6
MOST_GROUPS = 1_000_000


def _rate(positives: str = "positives", count: str = "count") -> Column:
    return F.col(positives) / F.col(count)


def _labelled(df: DataFrame, y: str | None) -> DataFrame:
    """Rows that have a label, with columns for counting them."""
    if y is None:
        return df.withColumns({"_one": F.lit(1), "_label": F.lit(0).cast("long")})
    return (df.where(F.col(y).isNotNull())
            .withColumns({"_one": F.lit(1), "_label": F.col(y).cast("long")}))


def _counts(df: DataFrame, keys: Sequence[str], y: str | None = None) -> DataFrame:
    """Rows and positives per key combination; rows without a label drop out."""
    return _labelled(df, y).groupBy(*keys).agg(
        F.count("_one").alias("count"), F.sum("_label").alias("positives"))


def _global_rate(df: DataFrame, y: str) -> Column:
    return df.agg(F.avg(y)).scalar()


def _all_present(keys: Sequence[str]) -> Column:
    keep = F.lit(True)
    for k in keys:
        keep = keep & F.col(k).isNotNull()
    return keep


def target_rates(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Target rate per level of many columns, stacked as (feature, value, ...): one scan."""
    texts = df.select(y, *[F.col(c).cast("string").alias(c) for c in cols if c != y])
    long = texts.unpivot([y], list(cols), "feature", "value").where(F.col("value").isNotNull())
    return _counts(long, ["feature", "value"], y).select(
        "feature", "value", _rate().alias("mean"), "count", "positives", (_rate() * 100).alias("rate_pct"))


def target_rate(df: DataFrame, col: str, y: str) -> DataFrame:
    """Mean, count, positives and percentage of the target per level, null levels left out."""
    stats = _counts(df.where(F.col(col).isNotNull()), [col], y)
    return stats.select(col, _rate().alias("mean"), "count", "positives", (_rate() * 100).alias("rate_pct"))


def smoothed_rate(df: DataFrame, keys: Sequence[str], y: str, m: float = 100) -> DataFrame:
    """Rate per group pulled towards the overall rate by ``m`` pseudo rows."""
    stats = _counts(df, keys, y)
    overall = stats.agg((F.sum("positives") / F.sum("count")).alias("rate")).scalar()
    pulled = (F.col("positives") + F.lit(float(m)) * overall) / (F.col("count") + F.lit(float(m)))
    return (stats.where(_all_present(keys)).select(*keys, F.col("positives").alias("sum"), "count", pulled.alias("smoothed_rate"))
            .withColumn("rate_pct", F.col("smoothed_rate") * 100))


def interaction_table(df: DataFrame, a: str, b: str, y: str, min_count: int = 100) -> DataFrame:
    """Rate, count and positives of each well-filled (a, b) combination."""
    stats = _counts(df.where(_all_present([a, b])), [a, b], y).where(F.col("count") >= min_count)
    return stats.select(a, b, _rate().alias("target_rate"), "count", "positives",
                        (_rate() * 100).alias("target_rate_pct"))


def interaction_range(table: DataFrame) -> DataFrame:
    """Groups and lowest and highest percentage of an ``interaction_table``."""
    return table.agg(F.count(F.lit(1)).alias("n_combinations"),
                     F.min("target_rate_pct").alias("min_pct"), F.max("target_rate_pct").alias("max_pct"))


def column_blocks(subsets: Sequence[Sequence[str]], sizes: Mapping[str, int], most: int) -> list[tuple[str, ...]]:
    """Few sets of columns so that every subset lies in one and none is expected to have over ``most`` groups,
    unless a subset alone has. ``sizes``: levels per column."""
    blocks: list[set[str]] = []
    for s in sorted(map(set, subsets), key=lambda s: -math.prod(sizes[c] for c in s)):
        fits = [b for b in blocks if math.prod(sizes[c] for c in b | s) <= most]
        if any(s <= b for b in blocks):
            continue
        if fits:
            min(fits, key=lambda b: len(s - b)).update(s)
        else:
            blocks.append(set(s))
    return [tuple(sorted(b)) for b in blocks]


def subset_counts(df: DataFrame, subsets: Sequence[Sequence[str]],
                  y: str | None = None) -> tuple[DataFrame, Column]:
    """Counts of every combination of every column subset, and the overall target rate.

    Rows (``subset``, ``count``, ``positives``), with ``subset`` the position in
    ``subsets``; combinations with a null key are left out. Rows are grouped once, by blocks of columns
    fine enough for several subsets each; subsets are counted from those groups, never from rows. Up to
    ``FEW`` columns are one block; more are dealt into blocks by their numbers of levels. A group of a subset
    is known by its number and the texts of its keys.
    """
    subsets = [tuple(s) for s in subsets]
    used = sorted({c for s in subsets for c in s})
    place = {c: i for i, c in enumerate(used)}
    rows = _labelled(df, y).select("_one", "_label", *used)
    sums = [F.count("_one").alias("count"), F.sum("_label").alias("positives")]
    if len(used) <= FEW:
        blocks = [tuple(used)]
        fine = rows.groupBy(*used).agg(*sums).withColumn("_block", F.lit(0))
    else:
        found = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in used]).first()
        blocks = column_blocks(subsets, {c: max(1, found[c]) for c in used}, MOST_GROUPS)
        # The bits of the columns a block leaves out, the first column highest.
        ids = [sum(1 << len(used) - 1 - place[c] for c in used if c not in b) for b in blocks]
        number = F.create_map(*[F.lit(x) for i, bits in enumerate(ids) for x in (bits, i)])
        fine = (rows.groupingSets([[F.col(c) for c in b] for b in blocks], *map(F.col, used))
                .agg(*sums, F.grouping_id(*used).alias("_bits")).withColumn("_block", number[F.col("_bits")]))
    # Block -> its subsets, each counted from the first block that holds it; subset -> places of its columns.
    of = [next(i for i, b in enumerate(blocks) if set(s) <= set(b)) for s in subsets]
    mine = F.array(*[F.array(*[F.lit(i) for i, b in enumerate(of) if b == k]).cast("array<int>") for k in range(len(blocks))])
    places = F.array(*[F.array(*[F.lit(place[c]) for c in s]) for s in subsets])
    texts = F.array(*[F.col(c).cast("string") for c in used])
    spread = fine.select("count", "positives", texts.alias("_texts"), F.explode(F.get(mine, F.col("_block"))).alias("subset"))
    keys = F.transform(F.get(places, F.col("subset")), lambda i: F.get(F.col("_texts"), i))
    stats = (spread.select("count", "positives", "subset", keys.alias("_keys")).where(~F.exists("_keys", lambda k: k.isNull()))
             .groupBy("subset", "_keys").agg(F.sum("count").alias("count"), F.sum("positives").alias("positives")))
    overall = fine.where("_block = 0").agg((F.sum("positives") / F.sum("count")).alias("rate")).scalar()
    return stats.drop("_keys"), overall


def _spread(stats: DataFrame, by: Sequence[str], overall: Column, min_count: int) -> DataFrame:
    """Groups kept, lowest and highest rate, their range, weighted mean deviation, per ``by``."""
    kept = (stats.where(F.col("count") >= min_count)
            .withColumn("rate", _rate()).withColumn("_base", overall))
    gap = F.abs(F.col("rate") - F.col("_base")) * F.col("count")
    return kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"),
        (F.max("rate") - F.min("rate")).alias("rate_range"),
        (F.sum(gap) / F.sum("count")).alias("weighted_std"))


def _named(subsets: Sequence[Sequence[str]], part: int) -> Column:
    return F.element_at(F.array(*[F.lit(s[part]) for s in subsets]), F.col("subset") + 1)


def _joined(subsets: Sequence[Sequence[str]]) -> Column:
    return F.element_at(F.array(*[F.lit(" × ".join(s)) for s in subsets]), F.col("subset") + 1)


def pair_interactions(df: DataFrame, cats: Sequence[str], y: str, min_count: int = 100) -> DataFrame:
    """Spread of the target rate for every pair of columns; pairs without a kept group are left out."""
    pairs = list(combinations(cats, 2))
    stats, overall = subset_counts(df, pairs, y)
    return _spread(stats, ["subset"], overall, min_count).select(
        _named(pairs, 0).alias("feature_1"), _named(pairs, 1).alias("feature_2"),
        F.col("n").alias("n_combinations"), "min_rate", "max_rate", "rate_range", "weighted_std")


def triple_interactions(df: DataFrame, cols: Sequence[str], y: str, min_count: int = 100) -> DataFrame:
    """Spread of the target rate for every triple of columns."""
    triples = list(combinations(cols, 3))
    stats, overall = subset_counts(df, triples, y)
    return _spread(stats, ["subset"], overall, min_count).select(
        _joined(triples).alias("features"), F.col("n").alias("n_groups"), "min_rate", "max_rate", "rate_range")


def combo_frequencies(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Per pair: number of combinations and their smallest, median and largest count."""
    pairs = list(combinations(cats, 2))
    stats, _ = subset_counts(df.select(*cats), pairs)
    # Counts repeat across combinations, so the median is taken over (count, how often).
    sizes = stats.groupBy("subset", "count").agg(F.count(F.lit(1)).alias("often"))
    return sizes.groupBy("subset").agg(
        F.sum("often").alias("n_combinations"), F.min("count").alias("min_count"),
        F.percentile("count", 0.5, F.col("often")).alias("median_count"), F.max("count").alias("max_count"),
    ).select(_joined(pairs).alias("features"), "n_combinations", "min_count", "median_count", "max_count")


def numeric_profiles(df: DataFrame, cols: Sequence[str], y: str, q: int = 10,
                     edges: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Target rate per quantile bin of many columns: one scan for edges, one for counts."""
    edges = edges or quantile_edges(df, cols, q)
    stats = _counts(unpivot_bins(df, edges, [y]), ["column", "bin"], y)
    return (stats.join(F.broadcast(edge_table(df, edges)), ["column", "bin"])
            .select("column", "bin", "lo", "hi", _rate().alias("mean"), "count", (_rate() * 100).alias("rate_pct")))


def numeric_profile(df: DataFrame, col: str, y: str, q: int = 10) -> DataFrame:
    """Target rate per quantile bin of a numeric column."""
    return numeric_profiles(df, [col], y, q).drop("column")


def numeric_cat_interactions(df: DataFrame, nums: Sequence[str], cats: Sequence[str], y: str, q: int = 5,
                             min_count: int = 100,
                             edges: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Spread of the target rate for each numeric-bin by category grid: one scan for edges, one for counts.

    Rows are grouped by (numeric column, bin, all categories) and only those groups are
    spread over the categories.
    """
    edges = edges or quantile_edges(df, nums, q)
    texts = df.select(y, *nums, *[F.col(c).cast("string").alias(f"_cat_{c}") for c in cats])
    cells = [f"_cat_{c}" for c in cats]
    fine = _counts(unpivot_bins(texts, edges, [y, *cells]), ["column", "bin", *cells], y)
    long = fine.unpivot(["column", "bin", "count", "positives"], cells, "category", "level")
    stats = (long.where(F.col("level").isNotNull()).groupBy("column", "bin", "category", "level")
             .agg(F.sum("count").alias("count"), F.sum("positives").alias("positives")))
    return _spread(stats, ["column", "category"], F.lit(0.0), min_count).select(
        F.col("column").alias("numerical"), F.substring("category", 6, 1 << 20).alias("categorical"),
        "min_rate", "max_rate", "rate_range")


def _remainders(df: DataFrame, cols: Sequence[str], mods: Sequence[int], sums: dict[str, Column]) -> DataFrame:
    """Sums per (feature, modulus, remainder).

    Rows are grouped by the remainder of the least common multiple first. It fixes the
    remainder of every modulus exactly, so rows are expanded once per column instead of
    once per column and modulus.
    """
    span = math.lcm(*mods)
    kinds = dict(df.dtypes)

    def rest(c: str) -> Column:
        # Whole numbers stay whole: as doubles they lose their last digits beyond 2^53.
        if kinds[c] in ("tinyint", "smallint", "int", "bigint") or kinds[c].endswith(",0)"):
            return (F.col(c) % F.lit(span)).cast("double")
        return F.col(c).cast("double") % F.lit(float(span))
    long = (df.select(*[rest(c).alias(c) for c in cols], *[v.alias(k) for k, v in sums.items()])
            .unpivot(list(sums), list(cols), "feature", "_r").where(F.col("_r").isNotNull()))
    coarse = long.groupBy("feature", "_r").agg(*[F.sum(k).alias(k) for k in sums], F.count(F.lit(1)).alias("count"))
    spread = coarse.withColumn("mod", F.explode(F.array(*[F.lit(m) for m in mods])))
    return (spread.withColumn("value", F.pmod(F.col("_r"), F.col("mod").cast("double")) + F.lit(0.0))
            .groupBy("feature", "mod", "value")
            .agg(*[F.sum(k).alias(k) for k in sums], F.sum("count").alias("count")))


def modulo_audit(df: DataFrame, cols: Sequence[str], mods: Sequence[int], y: str,
                 min_count: int = 100) -> DataFrame:
    """Per column and modulus: largest deviation of the rate by remainder, count-weighted rate, groups."""
    stats = _remainders(df.where(F.col(y).isNotNull()), cols, mods, {"positives": F.col(y).cast("long")})
    kept = (stats.where(F.col("count") >= min_count).withColumn("rate", _rate())
            .withColumn("_base", _global_rate(df, y)))
    return kept.groupBy("feature", F.concat(F.lit("mod_"), F.col("mod")).alias("operation")).agg(
        F.max(F.abs(F.col("rate") - F.col("_base"))).alias("max_deviation"),
        (F.sum("positives") / F.sum("count")).alias("weighted_rate"), F.count(F.lit(1)).alias("n_groups"))


def modulo_residuals(df: DataFrame, cols: Sequence[str], mods: Sequence[int], y: str, p: str) -> DataFrame:
    """Per column, modulus and remainder: rows, rate, mean prediction, mean residual and its size."""
    known = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    stats = _remainders(known, cols, mods, {"_y": F.col(y).cast("long"), "_p": F.col(p).cast("double")})
    gap = (F.col("_y") - F.col("_p")) / F.col("count")
    return stats.select("feature", "mod", "value", F.col("count").alias("n"),
                        (F.col("_y") / F.col("count")).alias("target_rate"),
                        (F.col("_p") / F.col("count")).alias("mean_prediction"),
                        gap.alias("mean_residual"), F.abs(gap).alias("residual_abs"))


def modulo_residual_audit(df: DataFrame, cols: Sequence[str], mods: Sequence[int], y: str, p: str) -> DataFrame:
    """Per column and modulus: number of remainders and the largest absolute mean residual."""
    return modulo_residuals(df, cols, mods, y, p).groupBy("feature", "mod").agg(
        F.count(F.lit(1)).alias("n_groups"), F.max("residual_abs").alias("max_abs_mean_residual"))
