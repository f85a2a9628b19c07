"""Exact dedup by chunk recipes.

Each text without its white space is cut where a rolling hash of its last 32 bytes says so.
A document becomes its recipe: the ordered list of its chunks. Chunks have a short identifier
that is verified against their SHA-256: where one short identifier stands for two different
chunks, documents that hold it are compared by the SHA-256 list instead. Only recipes move
(8 and 32 bytes for about a thousand); texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.texts import SPACE_BYTES, map_batches, mix32, strings
from propensity.session import stored

LEAST, MOST = 256, 16_384   # bytes of a chunk; only the last of a text may be shorter
_CUT_BITS = 10              # a cut every 1,024 bytes in the mean
_GEAR = mix32(np.arange(1, 257, dtype=np.uint32))


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``; equal bytes give equal cuts."""
    size = len(raw)
    if size <= LEAST:
        return [size] if size else []
    h = _GEAR[np.frombuffer(raw, np.uint8)]
    for s in (1, 2, 4, 8, 16):
        wider = h.copy()
        wider[s:] += h[:-s] << np.uint32(s)
        h = wider
    marks = np.flatnonzero(h >> np.uint32(32 - _CUT_BITS) == 0) + 1
    out, start = [], 0
    while size - start > LEAST:
        at = np.searchsorted(marks, start + LEAST)
        end = min(int(marks[at]) if at < len(marks) else size, start + MOST, size)
        out.append(end)
        start = end
    if start < size:
        out.append(size)
    return out


def recipes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """id, points (code points of the text), text_sha256, and short and strong, one entry for each chunk."""
    mask = (1 << bits) - 1

    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            points, whole, short, strong = [], [], [], []
            for x in strings(batch, "text"):
                raw = x.encode().translate(None, SPACE_BYTES)
                points.append(len(x))
                whole.append(hashlib.sha256(raw).hexdigest())
                start, a, b = 0, [], []
                for end in cuts(raw):
                    chunk = raw[start:end]
                    a.append((xxhash.xxh3_64_intdigest(chunk) & mask) - (1 << 63))
                    b.append(hashlib.sha256(chunk).digest())
                    start = end
                short.append(a)
                strong.append(b)
            return pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "points": pa.array(points, pa.int64()), "text_sha256": pa.array(whole),
                "short": pa.array(short, pa.list_(pa.int64())), "strong": pa.array(strong, pa.list_(pa.binary()))})
        return each

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(docs[id_col].alias("id"), docs[text].alias("text")), work,
                       f"id {kind}, points long, text_sha256 string, short array<long>, strong array<binary>")


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without the six ASCII white space characters; null
    counts as empty, and empty texts are equal to each other. The row with the most code points
    stays, of these the smallest id (a null id comes first). Rows that share an id and a text
    count one by one in group_size and are kept or dropped together. ``bits`` shortens the short
    identifier, for tests. Other columns are not read; an empty table gives an empty one.
    """
    found = stored(recipes(docs, id_col, text, bits), "recipes")
    chunk = found.select(F.explode(F.arrays_zip("short", "strong")).alias("c")).select("c.short", "c.strong").distinct()
    twice = chunk.groupBy("short").count().where("count > 1").select("short")
    doubtful = (found.select("text_sha256", F.explode("short").alias("short")).join(twice, "short", "left_semi")
                .select("text_sha256").distinct().withColumn("doubtful", F.lit(True)))
    listed = found.join(doubtful, "text_sha256", "left").select(
        "id", "points", "text_sha256", "short", F.when(F.col("doubtful"), F.col("strong")).alias("exact"))
    recipe = ["short", "exact"]
    best = listed.groupBy(*recipe).agg(F.min(F.struct(-F.col("points"), "id")).alias("best"),
                                        F.count(F.lit(1)).alias("group_size"))
    best = best.select(F.col("short").alias("s"), F.col("exact").alias("e"), F.col("best.id").alias("keep_id"), "group_size")
    return listed.join(best, (F.col("short") == F.col("s")) & F.col("exact").eqNullSafe(F.col("e"))).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``groups`` drops: of a null or repeated id only those of the dropped text."""
    gone = groups(docs, id_col, text).where("not kept").select(F.col(id_col).alias("_gone"), F.col("text_sha256").alias("_sha")).distinct()
    body = F.translate(F.coalesce(docs[text], F.lit("")), SPACE_BYTES.decode(), "")
    rows = docs.withColumn("_body", F.sha2(body.cast("binary"), 256))
    dropped = rows[id_col].eqNullSafe(gone["_gone"]) & (rows["_body"] == gone["_sha"])
    return rows.join(gone, dropped, "left_anti").select(*docs.columns)
