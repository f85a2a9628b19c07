"""Source divergence audit: how far the word use of each source is from its language and its fellows.

A first pass counts in how many documents of its language each term stands. The kept terms, sorted by
Spark, become minimal transducers that give each term's ordinal; the texts then stream through them and
are recounted, so that short numbers instead of terms cross the network. A lot of texts is numbered by its
distinct terms first, in Arrow arrays, so that a term takes its way once a lot. Ordinals stand for terms until
the last join, and break ties, since they rise as the terms do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.entropy_mix import numbered
from propensity.llm.transducer import Transducer
from propensity.session import stored

UNIT = 1_000_000_000
# Upper case to lower, every other ASCII character that is no letter to a space; other bytes are part of terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE = 500_000          # terms of one transducer
BLOCK = 64 << 20         # bytes of transducers that tasks hold at a time
FLUSH = 2 << 20          # bytes of texts that a task counts at once before it hands them on
CHUNK = 1 << 20          # numbers of a block that numpy works on at once


def _documents(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(docs[c], F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])


def _by_lang(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, pa.Table]]:
    """Rows of one language together, in lots of some ``limit`` bytes."""
    def lots() -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held)
    for lot in lots():
        langs = lot.column("lang").combine_chunks().dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            yield lang, lot.take(np.flatnonzero(codes == k)).combine_chunks()


def _terms(texts: pa.ChunkedArray, limit: int) -> Iterator[tuple[int, pa.StringArray, np.ndarray, np.ndarray]]:
    """Terms of about ``limit`` bytes of texts at a time, a text as a whole: place of the first text, distinct
    terms, and of each occurrence the term (its place among them) and the text (from 0)."""
    texts = pa.concat_arrays(texts.chunks).cast(pa.large_string()) if texts.num_chunks else pa.array([], pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + limit, "right")) - 1)
        raw = texts.buffers()[2][int(edges[start]):int(edges[stop])].to_pybytes().translate(LETTERS)
        part = pa.LargeStringArray.from_buffers(stop - start, pa.py_buffer(edges[start:stop + 1] - edges[start]), pa.py_buffer(raw))
        words = pc.ascii_split_whitespace(part)
        found = words.flatten().cast(pa.string()).dictionary_encode()
        codes, owner = found.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
        # Splitting leaves an empty word before a first space and after a last one.
        empty = found.dictionary.index("").as_py()
        if empty >= 0:
            codes, owner = codes[codes != empty], owner[codes != empty]
        yield start, found.dictionary, codes.astype(np.int64), owner.astype(np.int64)
        start = stop


def document_counts(given: DataFrame) -> DataFrame:
    """lang, term, docs: in how many documents of the language a term stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, rows in _by_lang(batches, FLUSH):
            for _, terms, codes, owner in _terms(rows.column("text"), FLUSH):
                once = np.unique(owner * len(terms) + codes) % max(1, len(terms))
                docs = np.bincount(once, minlength=len(terms))
                some = np.flatnonzero(docs)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(some)), terms.take(pa.array(some)), pa.array(docs[some].astype(np.int64))],
                                                 ["lang", "term", "docs"])
    return given.select("lang", "text").mapInArrow(run, "lang string, term string, docs long").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def vocabulary(given: DataFrame, least: int) -> DataFrame:
    """lang, term, ordinal: the terms in at least ``least`` documents of the language, numbered in byte order from 0."""
    kept = document_counts(given).where(F.col("docs") >= least).select("lang", "term")
    placed = stored(numbered(kept, ["lang", "term"], "place"), "terms")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))
    return placed.join(first, "lang").select("lang", "term", (F.col("place") - F.col("first")).alias("ordinal"))


def transducers(terms: DataFrame) -> DataFrame:
    """One row per language and ``PIECE`` terms: lang, base (the first ordinal) and the packed transducer."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ordinal")
        made = Transducer.build(t.encode() for t in rows["term"]).pack()
        return pd.DataFrame([{"lang": rows["lang"].iloc[0], "base": int(rows["ordinal"].iloc[0]), **made}])
    by = [F.col("lang"), F.floor(F.col("ordinal") / PIECE).alias("piece")]
    return terms.groupBy(*by).applyInPandas(build, "lang string, base long, key binary, target binary, passed binary, final binary, start long")


def _blocks(made: DataFrame) -> Iterator[list[tuple[str, int]]]:
    """Names (lang, base) of the transducers that fit ``BLOCK`` bytes together, at least one."""
    size = sum((F.length(c) for c in ("key", "target", "passed", "final")), F.lit(0))
    block, total = [], 0
    for lang, base, n in made.select("lang", "base", size).orderBy("lang", "base").collect():  # one small row per PIECE terms
        if block and total + n > BLOCK:
            yield block
            block, total = [], 0
        block.append((lang, base))
        total += n
    if block:
        yield block


def _recount(given: DataFrame, held) -> DataFrame:
    """lang, source, ordinal, n of the terms of the transducers in the broadcast ``held``: (lang, base, packed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[int, Transducer]]] = {}
        for lang, base, packed in held.value:
            known.setdefault(lang, []).append((base, Transducer.unpack(packed)))
        for lang, rows in _by_lang(batches, FLUSH):
            if lang not in known:
                continue
            sources = rows.column("source").combine_chunks().dictionary_encode()
            group = sources.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for first, terms, codes, owner in _terms(rows.column("text"), FLUSH):
                if not len(codes):
                    continue
                both, counts = np.unique(group[first + owner] * len(terms) + codes, return_counts=True)
                edges = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
                # A term takes its way through the transducer once for all its occurrences.
                text = np.frombuffer(terms.buffers()[2], np.uint8)
                for base, transducer in known[lang]:
                    place = transducer.ordinals(text, edges[:-1], edges[1:])[both % len(terms)]
                    hit = place >= 0
                    here = sources.dictionary.take(pa.array(both[hit] // len(terms)))
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(here)), here, pa.array(place[hit] + base), pa.array(counts[hit].astype(np.int64))],
                                                     ["lang", "source", "ordinal", "n"])
    return given.mapInArrow(run, "lang string, source string, ordinal long, n long").groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def recount(given: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, ordinal, n: occurrences of each kept term in each group, from the texts' stream through the transducers.

    Tasks hold at most ``BLOCK`` bytes of transducers (some four million terms) at a time; the texts are
    read once for each such block.
    """
    spark = given.sparkSession
    made = stored(transducers(terms), "transducers")
    counts = spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    for block in _blocks(made):
        mine = F.lit(False)
        for lang, base in block:
            mine = mine | ((F.col("lang") == lang) & (F.col("base") == base))
        packed = [(r["lang"], r["base"], {k: bytes(r[k]) if k != "start" else r[k] for k in ("key", "target", "passed", "final", "start")})
                  for r in made.where(mine).collect()]  # BLOCK bytes at most, or one transducer
        counts = counts.unionByName(stored(_recount(given, spark.sparkContext.broadcast(packed)), "counts"))
    return counts


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), in whole numbers; null where nothing is kept."""
    top = (count + F.lit(1)).cast("decimal(28,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = F.nullif(kept, F.lit(0)) + total
    return (F.call_function("div", top, below.cast("decimal(20,0)")) + 1).cast("long")


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(points: DataFrame, empty: DataFrame) -> DataFrame:
    """lang, a, b, value, touched: sums over the terms that stand in group a or b, and how many those are.

    ``points``: lang, ordinal, at (number of the group within its language), p. ``empty``: lang and the p of
    a term that does not occur, by number. A term meets each group of its language once for each group it
    stands in; terms in neither group are left to a product.
    """
    rows = points.groupBy("lang", "ordinal").agg(F.collect_list("at").alias("at"), F.collect_list("p").alias("p"))
    rows = rows.join(empty, "lang").select("lang", "at", "p", "empty")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            at, p = batch.column("at"), batch.column("p")
            for lang in dict.fromkeys(langs):
                mine = np.flatnonzero(np.array(langs, object) == lang)
                zero = np.array(batch.column("empty")[int(mine[0])].as_py(), np.int64)
                size = len(zero)
                value, touched = sums.setdefault(lang, (np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)))
                step = max(1, CHUNK // (size * size))
                for k in range(0, len(mine), step):
                    some = pa.array(mine[k:k + step])
                    places, shares = at.take(some), p.take(some)
                    term = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
                    group, here = places.flatten().to_numpy(), shares.flatten().to_numpy()
                    dense = np.tile(zero, (len(places), 1))
                    dense[term, group] = here
                    stands = np.zeros(dense.shape, bool)
                    stands[term, group] = True
                    own, others = here[:, None], dense[term]
                    np.add.at(value, group, (own - others) ** 2 // others)
                    np.add.at(value.T, group, np.where(stands[term], 0, (zero - own) ** 2 // own))
                    each, both = stands.sum(0), stands.astype(np.float64)
                    touched += each[:, None] + each[None, :] - np.rint(both.T @ both).astype(np.int64)
        for lang, (value, touched) in sums.items():
            a, b = map(np.ravel, np.indices(value.shape))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                              pa.array(value.ravel()), pa.array(touched.ravel())], ["lang", "a", "b", "value", "touched"])
    made = rows.mapInArrow(run, "lang string, a int, b int, value long, touched long")
    return made.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("touched").alias("touched"))


def audit(docs: DataFrame, least: int = 3, top: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    Null text, lang and source count as empty. Terms are runs of the letters A-Z (lower-cased), a-z and
    all characters beyond ASCII. A language keeps the terms in at least ``least`` of its documents. With c the
    count of a term in a group (lang, source), N the group's count of all kept terms and V their
    number, p = 1 + floor(10^9 (c + 1) / (N + V)); the language has the same over all its documents. The
    divergence of p from q is floor((p - q)^2 / q). Part ``pair`` ranks the other sources of the language by
    the sum over all kept terms, q the other's p (0 where nothing is kept); part ``term`` ranks the terms that
    occur in the group with p above the language's q, down to rank ``top``. Equal values stand in byte order of the
    items. Whole numbers throughout; a group without terms has its pairs and no terms; repeated rows
    are documents of their own. An empty table gives no rows. Other columns are not read.
    """
    given = _documents(docs, text, lang, source)
    groups = given.select("lang", "source").distinct()
    terms = stored(vocabulary(given, least), "vocabulary")
    counts = stored(recount(given, terms), "recount")
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").select(
        "lang", "source", number.alias("at"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")), "groups")
    groups = groups.withColumn("zero", share(F.lit(0), F.col("total"), F.col("kept")))
    points = counts.join(groups.select("lang", "source", "at", "total", "kept"), ["lang", "source"]).select(
        "lang", "source", "ordinal", "at", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    points = stored(points, "points")

    empty = groups.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "zero"))), lambda s: s["zero"]).alias("empty"))
    sums = stored(_pair_sums(points.select("lang", "ordinal", "at", "p"), empty.where("empty[0] is not null")), "pairs")
    other = groups.select("lang", F.col("at").alias("b"), F.col("source").alias("item"), F.col("zero").alias("q"))
    both = groups.withColumnRenamed("at", "a").join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    untouched = (F.col("kept") - F.coalesce("touched", F.lit(0))) * F.coalesce(gap(F.col("zero"), F.col("q")), F.lit(0))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", (F.coalesce("value", F.lit(0)) + untouched).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("whole"), F.max("kept").alias("kept"))
    langs = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang").select(
        "lang", "ordinal", share(F.col("n"), F.col("whole"), F.col("kept")).alias("q"))
    more = points.join(langs, ["lang", "ordinal"]).where("p > q").select(
        "lang", "source", "ordinal", gap(F.col("p"), F.col("q")).alias("value"))
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = more.withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= top)
    named = best.join(terms, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(named)
