"""Line dedup by an exact set-similarity join, in SQL expressions only.

A line is the set of its words. Words have an order from rare to frequent (by a count of all
words in ``BUCKETS`` hashed cells, then by hash: any fixed order gives the same result, a rare
word first gives few candidates). Two sets with a Jaccard similarity of 0.8 or more share one of
their first size - ceil(0.8 size) + 1 words, so only these prefixes are joined, within bands of sizes. Pairs whose sizes,
places of the shared word or 128 bits of parities rule the similarity out are dropped inside the join.
A line first asks its earliest candidate only, and all others if that one is not alike: pairs whose words share too
few 16-bit hashes are dropped, of the rest the words themselves are compared.
Lines with equal sets are one node of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.texts import SPACE
from propensity.session import stored

BUCKETS = 1 << 16
SIMILARITY = 0.8


def words(line: Column) -> Column:
    """Lower-cased words between ASCII white space, repeats included; a line has no line ends."""
    plain = F.lower(line)
    for space in "\t\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")  # cut at one character, which needs no pattern


def lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, no (from 0) and line; null and empty texts have no lines."""
    given = docs.where(F.length(text) > 0).select(docs[id_col].alias("id"), docs[text].alias("text"))
    return given.select("id", F.posexplode(F.split("text", "\n")).alias("no", "line"))


def _levels(docs: DataFrame, text: str) -> Column:
    """Frequency class of each cell above 56 bits, as a literal: twice the binary logarithm of its count, at most 126."""
    cell = F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("cell")
    all_words = docs.select(F.explode(F.split(F.lower(docs[text]), f"{SPACE}+")).alias("w"))
    counts = {r.cell: r.n for r in all_words.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).collect()}  # BUCKETS rows at most
    levels = (str(min(126, (counts.get(c, 0) ** 2).bit_length()) << 56) for c in range(BUCKETS))
    return F.expr(f"cast(split('{','.join(levels)}', ',') as array<bigint>)")


def _sets(rows: DataFrame, levels: Column, similarity: float) -> DataFrame:
    """id, no -> set (hash of the ordered words), size (0: no words), two parities and the prefix.

    A word is a whole number: its frequency class above 56 bits of its hash. The prefix holds 32
    bits of each, enough to find candidates.
    """
    def key(h: Column) -> Column:
        # Never null, so that Spark sorts plain numbers.
        level = F.coalesce(F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), F.lit(0))
        return level.bitwiseOR(F.shiftrightunsigned(h, 8))
    # A filter on the size would be moved below the words and cut every line twice.
    hashes = F.transform(words(F.col("line")), lambda w: F.xxhash64(w))
    rows = rows.select("id", "no", F.sort_array(F.transform(F.array_distinct(hashes), key)).alias("k"))
    one = F.lit(1).cast("long")

    def parity(half: int) -> Column:
        """Of the words of one half, 64 bits: how often each of 64 cells is met, odd or even."""
        mine = F.filter("k", lambda k: k.bitwiseAND(F.lit(64)) == F.lit(64 * half))
        return F.aggregate(mine, F.lit(0).cast("long"), lambda p, k: p.bitwiseXOR(
            F.call_function("shiftleft", one, k.bitwiseAND(F.lit(63)).cast("int"))))
    size = F.size("k")
    first = F.slice("k", F.lit(1), size - F.ceil(size * similarity - 1e-9).cast("int") + 1)
    return rows.select("id", "no", F.xxhash64("k").alias("set"), size.alias("size"),
                       parity(0).alias("parity"), parity(1).alias("parity2"), F.transform(first, lambda k: F.hash(k)).alias("prefix"))


def _marks(w: str) -> Column:
    """Distinct 16-bit hashes of words."""
    return F.array_distinct(F.transform(w, lambda x: F.shiftright(F.hash(x), 16).cast("smallint"))).alias("marks")


def _candidates(nodes: DataFrame, similarity: float) -> DataFrame:
    """y and x (id, no): places of two nodes that may be alike, x before y.

    Of two sets the smaller shares a word already in a shorter prefix: its first
    size - ceil(2 s / (1 + s) size) + 1 words, s the similarity. The larger one is at most 1 / s times as
    large: it lies in the same band of sizes (between powers of two) or in one that the smaller one reaches, where those
    first words stand once more.
    """
    def band(size: Column) -> Column:
        return F.floor(F.log2(size + 1e-6)).cast("int")

    def short(size: Column) -> Column:
        return size - F.ceil(size * (2 * similarity / (1 + similarity)) - 1e-9)

    # Both sides are the same rows, so that Spark shuffles them once.
    part = nodes.select("id", "no", "size", "parity", "parity2", F.posexplode("prefix").alias("place", "word"))
    size = F.col("size")
    bands = F.sequence(band(size), F.when(F.col("place") <= short(size), band(size / similarity)).otherwise(band(size)))
    part = part.withColumn("band", F.explode(bands)).select(
        (F.col("word").cast("long") * 64 + F.col("band")).alias("key"), "id", "no", "size", "parity", "parity2", "place")
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    both = a("size") + b("size")
    needed = F.ceil(both * similarity / (1 + similarity) - 1e-9)
    ahead = F.least(a("size") - a("place"), b("size") - b("place"))
    at, to = F.struct(a("id").alias("id"), a("no").alias("no")), F.struct(b("id").alias("id"), b("no").alias("no"))
    near = part.alias("a").join(part.alias("b"), a("key") == b("key")).where(
        (a("size") >= b("size")) & (b("size") >= a("size") * similarity - 1e-9)
        & (F.when(a("size") >= b("size"), b("place")) <= short(b("size")))
        & (F.least(a("place"), b("place")) + ahead >= needed)
        & (sum((F.bit_count(a(p).bitwiseXOR(b(p))) for p in ("parity", "parity2")), F.lit(0)) <= both - 2 * needed)
        & ((a("size") > b("size")) | (at > to)))
    return near.select(F.greatest(at, to).alias("y"), F.least(at, to).alias("x")).distinct()


def removed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """id and no of each line that an earlier line of any document matches.

    Lines stand in the order of id, then number.
    """
    levels = _levels(docs, text)
    all_lines = lines(docs, id_col, text)
    node = ["set", "size", "parity", "parity2"]
    sets = stored(_sets(all_lines, levels, similarity), "sets").where("size > 0")
    nodes = sets.groupBy(*node).agg(F.min(F.struct("id", "no", "prefix")).alias("first"), F.count(F.lit(1)).alias("n"))
    nodes = stored(nodes.select(*node, "first.*", "n"), "nodes")
    # The later line of each pair asks, the earlier one answers.
    asked = stored(_candidates(nodes, similarity), "asked")

    places = asked.select(F.explode(F.array("y", "x")).alias("at")).distinct()
    some = all_lines.select(F.struct("id", "no").alias("at"), "line").join(places, "at", "left_semi").distinct()
    some = some.withColumn("w", F.array_distinct(words(F.col("line")))).select("at", "line", F.size("w").alias("n"), _marks("w"))
    found = stored(some, "lines")

    def sides(tries: DataFrame, *cols: str) -> DataFrame:
        for c in "yx":
            tries = tries.join(found.select(F.col("at").alias(c), *(F.col(k).alias(f"{c}_{k}") for k in cols)), c)
        return tries

    def alike(common: Column, x: Column, y: Column) -> Column:
        """Common words are at least the similarity times all words; written so that they are counted once."""
        return common * (1 + similarity) >= similarity * (x + y) - 1e-9

    def matched(tries: DataFrame, label: str) -> DataFrame:
        """The asking lines of the pairs that are alike enough."""
        # Words that share a mark are at most as many as the marks are fewer than the words.
        given = sides(tries, "n", "marks")
        same = F.size(F.array_intersect("x_marks", "y_marks")) + F.least(*(F.col(f"{c}_n") - F.size(f"{c}_marks") for c in "xy"))
        likely = stored(given.where(alike(same, F.col("x_n"), F.col("y_n"))).select("y", "x"), label)
        w = sides(likely, "line").select("y", *(F.array_distinct(words(F.col(f"{c}_line"))).alias(f"{c}_w") for c in "xy"))
        is_match = alike(F.size(F.array_intersect("x_w", "y_w")), F.size("x_w"), F.size("y_w"))
        return w.select("y", is_match.alias("is_match")).where("is_match").select("y").distinct()

    # Nearly all that have a match have it in their earliest candidate. Only the others try all.
    earliest = stored(asked.groupBy("y").agg(F.min("x").alias("x")), "earliest")
    sure = stored(matched(earliest, "likely"), "matched")
    open_ = asked.join(sure, "y", "left_anti").join(earliest, ["y", "x"], "left_anti")
    later = stored(sure.unionByName(matched(open_, "likely_later")).distinct(), "matched")
    # A node's first line goes when it is matched, and its other lines always: they have the same words.
    copies = nodes.where("n > 1").select(*node, F.struct("id", "no").alias("at"))
    others = sets.select("id", "no", *node).join(copies, node).where(F.struct("id", "no") > F.col("at"))
    return later.select("y.id", "y.no").unionByName(others.select("id", "no"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per row: id, n_lines, n_removed and removed (numbers of the removed lines, from 0, ascending).

    A line is removed when any earlier line (of a lower id, or of the same text further up) has a
    set of words with a Jaccard similarity of ``similarity`` or more, whether that line stays or
    not. Lines without words stay. Null and empty texts have no lines. Rows that share an id are
    one document: they share their verdicts. A null id comes before all others. Other columns
    are not read.
    """
    gone = removed(docs, id_col, text, similarity).groupBy(F.col("id").alias("i")).agg(
        F.sort_array(F.collect_set("no")).alias("removed"))
    rows = docs.select(docs[id_col].alias("id"), F.when(F.length(text) > 0, F.size(F.split(docs[text], "\n")))
                       .otherwise(0).cast("long").alias("n_lines"))
    numbers = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.join(gone, F.col("id").eqNullSafe(F.col("i")), "left").select(
        F.col("id").alias(id_col), "n_lines", F.size(numbers).cast("long").alias("n_removed"), numbers.alias("removed"))


def clean(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the removed lines cut from the text."""
    gone = dedup(docs, id_col, text, similarity).where("n_removed > 0").select(
        F.col(id_col).alias("_id"), F.col("removed").alias("_gone")).dropDuplicates(["_id"])
    kept = F.array_join(F.filter(F.split(docs[text], "\n"), lambda line, k: ~F.coalesce(F.array_contains(gone["_gone"], k), F.lit(False))), "\n")
    both = docs.join(gone, docs[id_col].eqNullSafe(gone["_id"]), "left")
    return both.select(*(kept.alias(c) if c == text else docs[c] for c in docs.columns))
