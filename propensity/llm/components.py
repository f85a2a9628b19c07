"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Node and root: two nodes have the same root when a chain of links joins them.

    In each round every node moves to the least of itself and its neighbours under a hash order
    that changes with the round; links between moved nodes stay for the next one. A long path
    then shrinks by a constant share per round, where a fixed order would walk it node by node.
    Links to oneself and repeated links do no harm; nodes without links are not listed. Nothing
    comes to the driver but the question whether a link is left.
    """
    left = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    moves = []
    turn = 0
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        both = stored(both, "links")
        if both.isEmpty():
            break
        least = F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("root")))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("root"))
        move = stored(both.groupBy("a").agg(least.alias("m")).select(
            F.col("a").alias("node"), F.least("m", own)["root"].alias("root")), "moves")
        moves.append(move)
        to = lambda end: move.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))  # noqa: B023, E731
        left = (both.where("a < b").join(to("a"), "a").join(to("b"), "b")
                .select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).where("a <> b"))
        turn += 1
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0]
    for move in moves[1:]:
        then = move.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(then, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
