"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the mean number of times the mix takes it. Of all rates that meet the
word target of every source and stay within ``most``, those closest to taking each document once
(least relative entropy) are min(most, exp(a x size)), with one number a per source. The dual is
convex and falls apart by source; a solves

    sum over the source's documents of size x min(most, exp(a x size)) = target.

Newton's method runs for all sources at once, one distributed sum a round, inside a bracket that is
known beforehand. Documents of one source and size have one rate, so the sums run over such cells
with their counts; a cell's sums are whole numbers, so reruns give the same bits. Rates are then
rounded into copies cell by cell from the longest documents down, each cell taking over what the one
before left, and a hash order says which documents of a cell get the copy more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.texts import SPACE
from propensity.session import stored

NANO = 10**9             # rates and targets are rounded to this share before they become copies
DEALT = 50_000           # rows of a cell that are ranked in one window
ROUNDS = 200             # a bracket halves at least every second round, so that no source needs as many
SOURCE = ["missing", "source"]
CELL = [*SOURCE, "size"]


def _whole(column: Column) -> Column:
    """A whole number with room for sums beyond 64 bits."""
    return F.floor(column).cast("decimal(38,0)")


def numbered(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Distinct rows numbered from 0 in the order of ``columns``, by sorted ranges; no task holds them all."""
    at = df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("_part", F.spark_partition_id())
    at = stored(at, "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = at.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*columns))
    return at.join(parts, "_part").withColumn(out, F.col("_before") + within - 1).drop("_part", "_before")


def targets(sources: DataFrame, share: Fraction, weights: Sequence[int], most: int) -> DataFrame:
    """Sources (missing, source, words, docs) with their ``target``.

    The sources share ``share`` of all words by weight; what a source's share has above ``most`` times
    its words goes to the others by weight, until none is above. All comparisons are exact.
    """
    turn = F.col("place") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("decimal(20,0)")
    placed = stored(numbered(sources, SOURCE, "place").withColumn("weight", weight), "sources")
    words = placed.agg(F.sum("words")).first()[0] or 0
    over, above, open_, full = F.lit(False), words * share.numerator, None, -1
    while True:  # at least one source more reaches its bound in every round but the last
        found = placed.agg(F.count_if(over), F.sum(F.when(over, F.col("words"))), F.sum(F.when(~over, F.col("weight")))).first()
        if found[0] == full:
            break
        full, open_ = found[0], int(found[2] or 0)
        above = words * share.numerator - share.denominator * most * int(found[1] or 0)
        bound = F.col("words").cast("decimal(38,0)") * F.lit(most * share.denominator * open_).cast("decimal(38,0)")
        over = bound < F.col("weight") * F.lit(above).cast("decimal(38,0)")
        if not open_:
            over = F.lit(True)
            break
    level = F.col("weight").cast("double") * F.lit(float(above)) / F.lit(float(max(1, share.denominator * (open_ or 0))))
    return placed.withColumn("target", F.when(over, F.col("words") * F.lit(float(most))).otherwise(level)).drop("place", "weight")


def solve(cells: DataFrame, sources: DataFrame, most: int, close: float = 1e-10) -> DataFrame:
    """Sources with ``tilt``, the number a times the mean size; null where every document is taken ``most`` times.

    ``cells``: missing, source, size, n. A source without words has no tilt either.
    """
    ratio = F.col("target") / F.col("words")
    low = cells.where("size > 0").groupBy(*SOURCE).agg(F.min("size").alias("least"))
    state = sources.where("words > 0").join(low, SOURCE).withColumn("mean", F.col("words") / F.col("docs"))
    # x exp(-x) is 1/e at most: at -1/(e ratio) too little is taken; from ln(most) at the shortest on, everything.
    state = state.withColumns({
        "lo": -1 / (F.lit(2.718281828459045) * ratio), "hi": F.log(F.lit(float(most))) * F.col("mean") / F.col("least"),
        "tilt": F.lit(0.0), "done": F.lit(False)}).where(ratio < most)
    state = stored(state, "tilts")
    for _ in range(ROUNDS):
        if state.where("not done").isEmpty():
            break
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(most)), F.exp(F.col("tilt") * z))
        sums = cells.join(state.where("not done").select(*SOURCE, "mean", "tilt"), SOURCE).groupBy(*SOURCE).agg(
            F.sum(_whole(F.col("size") * rate * 1e6) * F.col("n")).alias("got"),
            F.sum(F.when(rate < most, _whole(F.col("size") * z * rate * 1e6) * F.col("n"))).alias("slope"))
        miss = F.col("got").cast("double") / 1e6 - F.col("target")
        step = F.col("tilt") - miss / F.nullif(F.col("slope").cast("double") / 1e6, F.lit(0.0))
        lo = F.when(miss <= 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(miss >= 0, F.col("tilt")).otherwise(F.col("hi"))
        inside = (step > lo) & (step < hi)
        done = F.col("done") | F.coalesce(F.abs(miss) <= F.col("target") * close, F.lit(False)) | (hi - lo <= F.abs(hi) * 1e-15)
        state = stored(state.join(sums, SOURCE, "left").select(
            *SOURCE, "words", "docs", "target", "least", "mean", F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
            F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
            F.when(done, F.col("tilt")).when(inside, step).otherwise((lo + hi) / 2).alias("tilt"), done.alias("done")), "tilts")
    return sources.join(state.select(*SOURCE, "mean", "tilt"), SOURCE, "left")


def _round(source: pd.DataFrame, most: int) -> pd.Series:
    """Copies of each cell of a source, in the order of its rows (longest first): the words taken come nearest the target."""
    rates = (source["rate"] * NANO).round().astype("int64").tolist()
    sizes, counts = source["size"].tolist(), source["n"].tolist()
    left = round(source["target"].iloc[0] * NANO) - sum(r * z * n for r, z, n in zip(rates, sizes, counts))
    copies = []
    for r, z, n in zip(rates, sizes, counts):
        left += r * z * n
        k = min(most * n, max(0, (2 * left + z * NANO) // (2 * z * NANO))) if z else 0
        left -= k * z * NANO
        copies.append(k)
    return pd.Series(copies, source.index, "int64")


def round_cells(cells: DataFrame, most: int) -> DataFrame:
    """``cells`` with ``copies``, those of all its documents together.

    A source's cells meet in one task: sizes that all differ add up, so a source of w words has
    fewer than sqrt(2 w) + 1 of them, a few million at 10^13 words.
    """
    def each(source: pd.DataFrame) -> pd.DataFrame:
        source = source.sort_values("size", ascending=False)
        return source.assign(copies=_round(source, most))

    schema = ", ".join(f"{n} {t}" for n, t in cells.dtypes) + ", copies long"
    return cells.groupBy(*SOURCE).applyInPandas(each, schema)


def mix(docs: DataFrame, share: Fraction = Fraction(3, 2), weights: Sequence[int] = (3, 1, 2), most: int = 2,
        id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: id, size, source_size, target, taken, copies, rate.

    ``size`` is the number of words (what stands between the six ASCII white space characters; null
    and empty texts have none and are taken 0 times), ``taken`` = size x copies the words the mix takes,
    ``rate`` the tilted rate before rounding. Sources are ordered by code point, null after all others
    and apart from the empty name, and take ``weights`` in turn. ``share`` of all words is shared; no
    target is above ``most`` times its source's words and no document is taken more often. Rows that
    repeat count each; ids may be null. Ties of the hash order fall to the id, and rows equal in id and
    text are alike. An empty table gives no rows. Other columns are not read.
    """
    count = F.regexp_count(F.coalesce(docs[text], F.lit("")), F.lit(SPACE.replace("[", "[^") + "+")).cast("long")
    rows = stored(docs.select(
        docs[id_col].alias("id"), docs[source].isNull().alias("missing"), F.coalesce(docs[source], F.lit("")).alias("source"),
        count.alias("size"), F.xxhash64(docs[id_col], docs[text]).alias("h")), "sizes")
    cells = stored(rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = cells.groupBy(*SOURCE).agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    sources = stored(targets(stored(sources, "sources"), share, weights, most), "targets")
    tilts = stored(solve(cells, sources, most), "solved")
    tilted = F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("mean")))
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("tilt").isNull(), float(most)).otherwise(tilted)
    rated = cells.join(tilts.select(*SOURCE, "words", "target", "tilt", "mean"), SOURCE).select(
        *CELL, "n", "words", "target", rate.alias("rate"))
    made = stored(round_cells(rated, most), "copies")
    shelf = F.floor(F.pmod(F.col("h"), F.lit(1 << 20)) * F.ceil(F.col("n") / DEALT) / (1 << 20))
    dealt = stored(rows.join(made, CELL).withColumn("shelf", shelf), "dealt")
    before = Window.partitionBy(*CELL).orderBy("shelf").rowsBetween(Window.unboundedPreceding, -1)
    shelves = dealt.groupBy(*CELL, "shelf").agg(F.count(F.lit(1)).alias("here"))
    shelves = shelves.select(*CELL, "shelf", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*CELL, "shelf").orderBy("h", "id"))
    more = (rank <= F.col("copies") % F.col("n")).cast("long")
    found = dealt.join(shelves, [*CELL, "shelf"]).withColumn("copies", F.floor(F.col("copies") / F.col("n")) + more)
    return found.select(F.col("id").alias(id_col), "size", F.col("words").alias("source_size"), "target",
                        (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")
