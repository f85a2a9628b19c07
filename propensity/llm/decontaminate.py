"""Benchmark decontamination in SQL expressions: SimHash windows, Hamming blocks, exact similarity.

A window of a document is as long as an item (in words; a shorter document is one window). It
leaks the item when the fingerprints of their five-word shingles differ in at most ``RADIUS``
bits and the weighted Jaccard similarity of their shingles (each weighted by how often it
occurs) is ``SIMILARITY`` or more. Fingerprints are split into ``RADIUS + 1`` blocks: two that
differ in at most ``RADIUS`` bits agree in one block at least, so a join on blocks misses none.

Windows that cannot leak are not built: a similar window misses at most the share
1 - SIMILARITY of an item's shingles, so it holds one of any larger set of them; the first ones
are looked up. What depends on a text alone is computed once for all its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.texts import SPACE, filtered_joins
from propensity.session import stored

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 20      # two windows of similarity 0.8 differ in about 10 of 64 bits, with a deviation of 3


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; none for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), f"{SPACE}+")
    return F.filter(parts, lambda w: w != "")


def shingles(found: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order."""
    none = F.array().cast("array<bigint>")
    last = F.size(found) - width
    return F.when(last < 0, none).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*(F.get(found, i + k) for k in range(width)))))


def fingerprint(hashes: Column) -> Column:
    """A bit is 1 where over half of the hashes have 1."""
    half = F.size(hashes)
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
                       lambda f, b: f.bitwiseOR(F.when(ones(b) * 2 > half, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(
                           F.lit(0).cast("long"))))


def fingerprints(df: DataFrame, keys: list[str], hashes: str, out: str) -> DataFrame:
    """The same for many rows: keys and fingerprint.

    Bits are summed by an aggregation, which is compiled and sums a row's hashes before the
    shuffle; two bits share a sum, 32 binary places apart.
    """
    pair = F.lit((1 << 32) + 1)
    bits = df.select(*keys, F.explode(hashes).alias("h")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *(F.sum(F.shiftrightunsigned("h", b).bitwiseAND(pair)).alias(f"_{b}") for b in range(32)))
    f = F.lit(0).cast("long")
    for b in range(32):
        low, high = F.col(f"_{b}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(F.col(f"_{b}"), 32)
        for count, at in ((low, b), (high, b + 32)):
            one = F.lit((1 << at) - (1 << 64) * (at == 63)).cast("long")
            f = f.bitwiseOR(F.when(count * 2 > F.col("_n"), one).otherwise(F.lit(0).cast("long")))
    return bits.select(*keys, f.alias(out))


def blocks(f: Column, radius: int) -> Column:
    """(block number, its bits) of each of radius + 1 blocks."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*(F.struct(F.lit(k).alias("no"), F.shiftrightunsigned(f, a).bitwiseAND(F.lit((1 << b - a) - 1)).alias("bits"))
                     for k, (a, b) in enumerate(zip(cuts, cuts[1:]))))


def shared(a: Column, b: Column) -> Column:
    """Size of the common part of two multisets."""
    def times(x, of):
        return F.size(F.filter(of, lambda y: y == x))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(x, a), times(x, b)))


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    df = benchmark.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w"))
    df = df.withColumn("n", F.size("w")).where("n > 0").withColumn("width", F.least("n", F.lit(WIDTH)))
    own = F.when(F.col("width") == WIDTH, shingles(F.col("w"), WIDTH))
    for k in range(1, WIDTH):
        own = own.when(F.col("width") == k, shingles(F.col("w"), k))
    df = df.withColumn("own", own)
    return df.select("item", "n", "width", "own", fingerprint(F.col("own")).alias("f"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Per leaked item of a text: key (md5 of the text), item, start of the first best window (in words), similarity."""
    items = stored(_items(benchmark, item_id, item_text), "items")
    least = F.ceil(F.size("own") * similarity - 1e-9).cast("int")
    first = items.select("n", "width", F.explode(F.slice("own", F.lit(1), F.size("own") - least + 1)).alias("h")).distinct()
    first = stored(first, "first")  # its true size tells the planner whether to broadcast it
    key = F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key")
    widths = sorted(r.width for r in first.select("width").distinct().collect())  # five numbers at most
    hits = None
    for width in widths:
        at = (docs.select(key, words(F.col(text)).alias("w"))
              .select("key", F.size("w").alias("length"), F.posexplode(shingles(F.col("w"), width)).alias("pos", "h")))
        at = at.join(first.where(F.col("width") == width).drop("width"), "h").select(
            "key", "length", "pos", "n", F.lit(width).alias("width"))
        hits = at if hits is None else hits.unionByName(at)
    if hits is None:
        return docs.select(key, F.lit(None).cast(dict(benchmark.dtypes)[item_id]).alias("item"), F.lit(0).alias("start"),
                           F.lit(0.0).alias("similarity")).where("false")
    hits = stored(hits.distinct(), "hits")

    lowest = F.greatest(F.lit(0), F.col("pos") - F.col("n") + F.col("width"))
    highest = F.least(F.col("pos"), F.greatest(F.lit(0), F.col("length") - F.col("n")))
    windows = hits.where(lowest <= highest).select(
        "key", "n", "width", F.explode(F.sequence(F.least(lowest, highest), highest)).alias("start")).distinct()
    some = stored(hits.groupBy("key").agg(F.count(F.lit(1)).alias("times")), "keys").where("times > 0").select("key")
    texts = docs.select(key, F.col(text).alias("_text")).join(some, "key").groupBy("key").agg(F.first("_text").alias("_text"))
    with filtered_joins(docs.sparkSession):
        texts = stored(texts.select("key", words(F.col("_text")).alias("w")), "words")
    part = F.slice("w", F.col("start") + 1, F.col("n"))
    own = F.when(F.col("width") == WIDTH, shingles(F.col("part"), WIDTH))
    for k in range(1, WIDTH):
        own = own.when(F.col("width") == k, shingles(F.col("part"), k))
    windows = (texts.join(windows, "key").select("key", "n", "start", "width", part.alias("part"))
               .select("key", "n", "start", own.alias("w_own")).where("size(w_own) > 0"))
    windows = stored(windows, "windows")

    side = items.select("item", "n", "f", F.explode(blocks(F.col("f"), radius)).alias("block"))
    prints = fingerprints(windows, ["key", "start", "n"], "w_own", "w_f")
    asks = prints.select("key", "start", "n", "w_f", F.explode(blocks(F.col("w_f"), radius)).alias("block"))
    near = asks.join(side, ["n", "block"]).where(F.bit_count(F.col("f").bitwiseXOR(F.col("w_f"))) <= radius)
    near = near.select("key", "start", "n", "item").distinct()
    both = near.join(windows, ["key", "start", "n"]).join(items.select("item", "own"), "item")
    common = both.withColumn("common", shared(F.col("own"), F.col("w_own")))
    total = F.size("own") + F.size("w_own") - F.col("common")
    found = common.withColumn("similarity", F.col("common") / total).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("at")))
    return found.groupBy("key", "item").agg(best.alias("b")).select(
        "key", "item", (-F.col("b.at")).alias("start"), "b.similarity")


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: id, contaminated, items (ascending) and the highest similarity (0 if none).

    Null and empty texts and items leak nothing; an item of fewer than five words is one shingle
    of all its words. Items of equal text are all listed, items without an id are not. Repeated
    rows repeat; other columns are not read.
    """
    found = leaks(docs, benchmark, id_col, text, **options)
    found = stored(found.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"),
                                            F.max("similarity").alias("similarity")), "leaks")
    rows = docs.select(F.col(id_col), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"))
    none = F.array().cast(found.schema["items"].dataType)
    return rows.join(found, "key", "left").select(
        id_col, F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that leak an item."""
    gone = stored(leaks(docs, benchmark, text=text, **options).select(F.col("key").alias("_key")).distinct(), "leaks")
    return docs.join(gone, F.md5(F.coalesce(docs[text], F.lit(""))) == gone["_key"], "left_anti")
