"""Repeated passages by a run-length index: every byte of a string of 400 that starts elsewhere too.

Finding where to look. A hash orders the 17-byte grams of a text; the least gram of each window
of 400 bytes is its anchor (about one per 190 bytes). Equal windows have equal anchors at equal
places. A window holds either the 209 bytes from its anchor on or the 209 bytes that end with
it: its core. Each anchor asks for the cores of its windows whether they occur elsewhere. Where
all that share a core are equal around it too, as far as the windows of the anchor reach, they
are repeated as a whole and need no index; of others one of each kind is indexed.

Index. Contexts that share a core are sorted by what follows it; this is the suffix order at
the core. Stepping to the left, the bytes before the suffixes, in suffix order, are the
Burrows-Wheeler transform of the contexts, and sorting by them keeps the order within equal
bytes. Only the runs of the transform matter: inside a run neighbours stay neighbours and their
common prefix grows by one, so it is looked up at the ends of runs alone, as the least of the
stretch between two runs of a byte. Each step thus streams the matching statistics of all
contexts: the length of the longest match elsewhere, that of the nearer neighbour. Where it
is 400 or more, a window is repeated.

A core with more than ``MANY`` different contexts is not indexed in one task: its windows are
counted by hash over all tasks. The answer is the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.texts import filtered_joins, map_batches, mix32
from propensity.session import stored

LENGTH = 400
GRAM = 17
CORE = (LENGTH + 1 + GRAM) // 2   # 209
REST = LENGTH - CORE              # bytes of a window outside its core
MANY = 20_000                     # different contexts of a core that one task indexes
BATCH = 20_000                    # contexts indexed at once
SEGMENT = 4_000_000               # bytes looked at at once
_BYTE = mix32(np.arange(1, 257, dtype=np.uint32))


def _binary(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def anchors(raw: bytes) -> np.ndarray:
    """Rows (anchor, first, last): the windows that start from first to last have this anchor,
    the least gram, the first of equal ones."""
    found = []
    for at in range(0, max(1, len(raw) - LENGTH + 1), SEGMENT):
        part = np.frombuffer(raw, np.uint8)[at:at + SEGMENT + LENGTH - 1]
        if len(part) < LENGTH:
            break
        h, factor, width = _BYTE[part], 0x01000193, 1
        while 2 * width <= GRAM:
            h = h[:-width] * np.uint32(factor) + h[width:]
            factor, width = factor * factor & 0xFFFFFFFF, 2 * width
        if width < GRAM:
            h = h[:-(GRAM - width)] * np.uint32(0x85EBCA6B) + h[GRAM - width:]
        low = mix32(h).astype(np.uint64) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
        grams, width = LENGTH - GRAM + 1, 1
        while 2 * width <= grams:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < grams:
            low = np.minimum(low[:-(grams - width)], low[grams - width:])
        low &= np.uint64(0xFFFFFFFF)
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        last = np.concatenate((first[1:], [len(low)])) - 1
        found.append(np.column_stack((low[first].astype(np.int64), first, last)) + at)
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def cores(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Side, start of the core, and least and most bytes that the windows reach before it."""
    p, first, last = anchors(raw).T
    edge = p - (CORE - GRAM)              # windows that start up to here hold the core before the anchor
    left, right = first <= edge, last > edge
    side = np.repeat([0, 1], [left.sum(), right.sum()])
    core = np.concatenate((edge[left], p[right]))
    low = core - np.concatenate((np.minimum(last, edge)[left], last[right]))
    high = core - np.concatenate((first[left], np.maximum(first, edge + 1)[right]))
    return side, core, low, high


def _questions(rows: DataFrame) -> DataFrame:
    """rid, raw -> per anchor and core: ask and context (hashes), rid and place (core, least and most before it)."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            taken, ask, context, place = [], [], [], []
            digest = xxhash.xxh3_64_intdigest
            for i, raw in enumerate(_binary(batch, "raw")):
                if len(raw) < LENGTH:
                    continue
                side, core, low, high = cores(raw)
                taken.append(np.full(len(core), i))
                place.append(core << 16 | low << 8 | high)
                side, core, low, high = side.tolist(), core.tolist(), low.tolist(), high.tolist()
                ask += [digest(raw[c:c + CORE], s) for s, c in zip(side, core)]
                context += [digest(raw[c - b:c + LENGTH - a], b) for c, a, b in zip(core, low, high)]
            whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            return pa.RecordBatch.from_pydict({"ask": signed(ask), "context": signed(context), "place": pa.array(whole(place)),
                                               "rid": batch.column("rid").take(pa.array(whole(taken)))})
        return each
    return map_batches(rows, work, "ask long, context long, place long, rid long")


def _padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row per text, bytes counted from 1 and 0 past the end; and the lengths."""
    length = np.array([len(p) for p in parts], np.int64)
    flat = np.frombuffer(b"".join([p.ljust(REST, b"\0") for p in parts]), np.uint8).reshape(-1, REST)
    return np.where(np.arange(REST) < length[:, None], flat.astype(np.int16) + 1, np.int16(0)), length


def repeated(asks: list[int], left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per context the least and the most bytes before the core of its repeated windows (most is -1: none).

    A context is what stands left and right of a core, at most REST bytes each; contexts with
    the same ask share the core. No two contexts are equal.
    """
    n = len(asks)
    least, most = np.full(n, LENGTH), np.full(n, -1)
    order = np.array(sorted(range(n), key=lambda i: (asks[i], right[i])), np.int64)
    after, size = _padded([right[i] for i in order])
    before = _padded([p[::-1] for p in left])[0]
    own = np.array([asks[i] for i in order], np.int64)
    group = np.concatenate(([0], np.cumsum(own[1:] != own[:-1])))   # by place in the order, then by context
    unlike = after[1:] != after[:-1]
    match = np.where(unlike.any(1), unlike.argmax(1), REST)
    match = np.minimum(match, np.minimum(size[1:], size[:-1])) + CORE
    common = np.concatenate(([0], np.where(group[1:] == group[:-1], match, 0)))  # with the one before in order
    of = np.empty(n, np.int64)
    of[order] = group
    for step in range(REST + 1):
        if step:
            byte = before[order, step - 1]
            key = of[order] * 257 + byte
            moved = np.argsort(key, kind="stable")
            key = key[moved]
            same = (key[1:] == key[:-1]) & (byte[moved][1:] > 0)
            was, now = moved[:-1], moved[1:]
            grown = np.zeros(len(order), np.int64)
            inside = np.flatnonzero(same & (now == was + 1))         # inside a run
            grown[inside + 1] = common[now[inside]] + 1
            edge = np.flatnonzero(same & (now != was + 1))           # from the end of one run to the next
            if len(edge):
                cuts = np.column_stack((was[edge] + 1, now[edge] + 1)).ravel()
                grown[edge + 1] = np.minimum.reduceat(np.append(common, 0), cuts)[::2] + 1
            order, common = order[moved], grown
        hit = common >= LENGTH
        hit[:-1] |= hit[1:].copy()
        at = order[hit]
        least[at] = np.minimum(least[at], step)
        most[at] = step
        if step % 8 == 7:                                            # those that match nothing drop out
            alive = common > 0
            alive[:-1] |= common[1:] > 0
            order, common = order[alive], common[alive]
            if not len(order):
                break
    return least, most


def _index(contexts: DataFrame) -> DataFrame:
    """ask, context, left, right (rows of an ask together) -> ask, context, least, most."""
    def run(batches):
        waiting: dict[tuple[int, int], tuple[bytes, bytes]] = {}
        last = None

        def flush():
            keys = list(waiting)
            least, most = repeated([k[0] for k in keys], [v[0] for v in waiting.values()], [v[1] for v in waiting.values()])
            waiting.clear()
            hit = most >= 0
            both = np.array(keys, np.int64).reshape(-1, 2)[hit]
            return pa.RecordBatch.from_pydict({"ask": pa.array(both[:, 0]), "context": pa.array(both[:, 1]),
                                               "least": pa.array(least[hit].astype(np.int32)),
                                               "most": pa.array(most[hit].astype(np.int32))})
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ask", "context", "left", "right"))
            for ask, context, left, right in zip(*columns):
                if ask != last and len(waiting) >= BATCH:
                    yield flush()
                last = ask
                waiting[ask, context] = (left, right)
        if waiting:
            yield flush()
    return contexts.mapInArrow(run, "ask long, context long, least int, most int")


def _windows(contexts: DataFrame) -> DataFrame:
    """The same by counting the hashes of all windows of the contexts."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("ask", "context", "left", "right"))
            for ask, context, left, right in zip(*columns):
                for e in range(max(0, REST - len(right)), len(left) + 1):
                    h = xxhash.xxh3_128_digest(left[len(left) - e:] + right[:REST - e], seed=e)
                    rows.append((h, ask, context, e))
            h, ask, context, e = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_pydict({"h": pa.array(h, pa.binary()), "ask": pa.array(ask, pa.int64()),
                                               "context": pa.array(context, pa.int64()), "e": pa.array(e, pa.int32())})
        return each
    rows = map_batches(contexts, work, "h binary, ask long, context long, e int").distinct()
    twice = rows.groupBy("ask", "h").count().where("count > 1").select("ask", "h")
    return rows.join(twice, ["ask", "h"]).groupBy("ask", "context").agg(F.min("e").alias("least"), F.max("e").alias("most"))


def _contexts(texts: DataFrame) -> DataFrame:
    """raw and wanted (ask, context, place) -> one row per wanted context: ask, context, left, right."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ask, context, left, right = [], [], [], []
            for raw, wanted in zip(_binary(batch, "raw"), batch.column("wanted").to_pylist()):
                for w in wanted:
                    core, low, high = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                    ask.append(w["ask"])
                    context.append(w["context"])
                    left.append(raw[core - high:core])
                    right.append(raw[core + CORE:core + LENGTH - low])
            return pa.RecordBatch.from_pydict({"ask": pa.array(ask, pa.int64()), "context": pa.array(context, pa.int64()),
                                               "left": pa.array(left, pa.binary()), "right": pa.array(right, pa.binary())})
        return each
    return map_batches(texts.select("raw", "wanted"), work, "ask long, context long, left binary, right binary")


def _cut(texts: DataFrame) -> DataFrame:
    """rid, raw and spans -> rid, spans merged, n_removed, kept."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            merged, removed, kept = [], [], []
            for raw, spans in zip(_binary(batch, "raw"), batch.column("spans").to_pylist()):
                own: list[list[int]] = []
                for a, b in sorted((s["a"], s["b"]) for s in spans):
                    if own and a <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], b)
                    else:
                        own.append([a, b])
                merged.append([{"a": a, "b": b} for a, b in own])
                removed.append(sum(b - a for a, b in own))
                edges = [0, *(x for s in own for x in s), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            return pa.RecordBatch.from_pydict({"rid": batch.column("rid"), "spans": pa.array(merged, kind),
                                               "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary())})
        return each
    return map_batches(texts.select("rid", "raw", "spans"), work,
                       "rid long, spans array<struct<a:long,b:long>>, n_removed long, kept binary")


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, rid and raw. rid is a hash of id and text, the same for repeated rows."""
    raw = F.coalesce(docs[text], F.lit(""))
    return docs.select(docs[id_col].alias("id"), F.xxhash64(F.coalesce(docs[id_col].cast("string"), F.lit("-")), raw).alias("rid"),
                       raw.alias("raw"))


def _span(least, most) -> list:
    core = F.shiftright("place", 16)
    return [(core - most).alias("a"), (core - least + LENGTH).alias("b")]


def remove(docs: DataFrame, id_col: str = "doc_id", text: str = "text", many: int = MANY) -> DataFrame:
    """Per text with repeated passages: rid, spans, n_removed, kept (the bytes that stay)."""
    rows = _rows(docs, id_col, text).select("rid", "raw")
    asked = stored(_questions(rows), "questions")
    known = asked.groupBy("ask").agg(F.count(F.lit(1)).alias("times"), F.min("context").alias("low"),
                                     F.max("context").alias("high")).where("times > 1")
    again = stored(asked.join(known.select("ask", (F.col("low") == F.col("high")).alias("same")), "ask"), "again")
    whole = _span(F.shiftright("place", 8).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(255)))
    same = again.where("same").select("rid", *whole)

    kinds = stored(again.where("not same").groupBy("ask", "context").agg(
        F.count(F.lit(1)).alias("times"), F.min("rid").alias("rid"), F.min_by("place", F.struct("rid", "place")).alias("place")),
        "kinds")
    crowded = kinds.groupBy("ask").count().where(F.col("count") > many).select("ask", F.lit(True).alias("crowded"))
    wanted = kinds.join(crowded, "ask", "left")
    ids = stored(again.groupBy("rid").agg(F.count(F.lit(1)).alias("n")), "ids").where("n > 0").select("rid")
    with filtered_joins(docs.sparkSession):
        texts = stored(rows.join(ids, "rid").dropDuplicates(["rid"]), "texts")

    def contexts(side):
        listed = side.groupBy("rid").agg(F.collect_list(F.struct("ask", "context", "place")).alias("wanted"))
        return _contexts(texts.join(listed, "rid"))

    plain = contexts(wanted.where("crowded is null")).repartition("ask").sortWithinPartitions("ask")
    marks = _index(plain).unionByName(_windows(contexts(wanted.where("crowded"))))
    # A context that occurs more than once is repeated as a whole.
    often = kinds.where("times > 1").select("ask", "context", F.shiftright("place", 8).bitwiseAND(F.lit(255)).cast("int").alias("least"),
                                            F.col("place").bitwiseAND(F.lit(255)).cast("int").alias("most"))
    marks = stored(marks.unionByName(often).groupBy("ask", "context").agg(F.min("least").alias("least"), F.max("most").alias("most")),
                   "marks")
    found = again.where("not same").join(marks, ["ask", "context"]).select("rid", *_span(F.col("least"), F.col("most")))
    spans = same.unionByName(found).groupBy("rid").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    return _cut(texts.join(spans, "rid"))


def digest(docs: DataFrame, id_col: str = "doc_id", text: str = "text", many: int = MANY) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, repeats (whether anything was removed).

    Null counts as empty. Texts of fewer than 400 bytes keep everything; a copy of a longer text
    loses everything, in every copy. Repeated rows are copies of each other. Rows without an id
    are told apart by their texts. Other columns are not read.
    """
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "rid": batch.column("rid"), "n_removed": batch.column("n_removed"),
                "n_spans": pa.array([len(s) for s in batch.column("spans").to_pylist()], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in batch.column("kept").to_pylist()], pa.string())})
        return each
    cut = map_batches(remove(docs, id_col, text, many), work, "rid long, n_removed long, n_spans long, kept_sha256 string")
    all_rows = _rows(docs, id_col, text).select("id", "rid", F.octet_length("raw").cast("long").alias("n_bytes"),
                                                F.sha2(F.col("raw").cast("binary"), 256).alias("whole"))
    return all_rows.join(cut, "rid", "left").select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        (F.coalesce("n_removed", F.lit(0)) > 0).alias("repeats"))
