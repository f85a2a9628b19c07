"""SimHash near-dedup: fingerprints, links by a grid over segment bit counts, components.

Bits of a fingerprint are counted in eight segments of eight bits. Two fingerprints that differ
in d bits differ by at most d in the sum of their count differences (Manhattan distance), so all
pairs within a radius lie in cells of the count grid at most that far apart. Each fingerprint
asks one half of the cells around its own, the other half asks it; what meets is compared bit
by bit. Counts alone would let a fixed share of all pairs meet, so there are three grids: two bits
leave one of three blocks of segments as it is, and each grid takes that block's bits whole and
the counts of the other segments. Equal fingerprints are one node, so copies never meet in pairs.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.components import components
from propensity.llm.texts import map_batches, strings
from propensity.session import stored

SEGMENTS = 8             # of eight bits each
BLOCKS = ((0, 1, 2), (3, 4, 5), (6, 7))  # one more than the radius
RADIUS = 2
SEED = 42


def shingle_hashes(text: str, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle as rows of eight bytes, highest first; no words give no rows.

    Words are what stands between the six ASCII white space characters, A-Z lower-cased; a text
    of fewer words than ``width`` is one shingle.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros((0, 8), np.uint8)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[i:j], seed) for i, j in zip(starts[:n].tolist(), ends[-n:].tolist())])
    return np.frombuffer(raw, np.uint8).reshape(-1, 8)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 where over half of the hashes have 1; as a signed 64-bit number."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        count += np.unpackbits(hashes[i:i + 8192], axis=1).sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, hash (of the text) and f, of every row; null counts as empty, and without words f is 0."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(shingle_hashes(x, width)) for x in strings(batch, "text")]
            return pa.RecordBatch.from_pydict({"id": batch.column("id"), "hash": batch.column("hash"), "f": pa.array(found, pa.int64())})
        return each

    kind = dict(docs.dtypes)[id_col]
    given = docs.select(docs[id_col].alias("id"), _hash(docs[text]).alias("hash"), docs[text].alias("text"))
    return map_batches(given, work, f"id {kind}, hash long, f long")


def _hash(text: Column) -> Column:
    """Tells the texts of a repeated id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _grids(points: DataFrame) -> DataFrame:
    """f, block, own, cell: per block a hash of its bits and the bit counts of the other segments, four bits
    each, with room for two steps down and up."""
    f, grids = F.col("f"), []
    for at, block in enumerate(BLOCKS):
        mask = sum(255 << 8 * k for k in block)
        own = F.xxhash64(F.lit(at), f.bitwiseAND(F.lit(mask - 2**64 if mask >> 63 else mask)))
        cell = F.lit(0).cast("long")
        for i, k in enumerate(k for k in range(SEGMENTS) if k not in block):
            part = F.shiftrightunsigned(f, 8 * k).bitwiseAND(F.lit(255))
            cell = cell + F.shiftleft(F.bit_count(part).cast("long") + 2, 4 * i)
        grids.append(F.struct(F.lit(at).alias("block"), own.alias("own"), cell.alias("cell")))
    return points.select("f", F.explode(F.array(*grids)).alias("grid")).select("f", "grid.*")


def steps(radius: int, segments: int) -> list[int]:
    """Offsets between cells up to ``radius`` apart: of each two opposite ones the first, and 0."""
    out = [0]
    for move in product(range(-radius, radius + 1), repeat=segments):
        if 0 < sum(map(abs, move)) <= radius and next(m for m in move if m) > 0:
            out.append(sum(m << 4 * k for k, m in enumerate(move)))
    return out


def met(points: DataFrame, radius: int) -> DataFrame:
    """f, g: the numbers of column f that a grid brings together, some of them repeatedly."""
    grids = _grids(points)
    at = grids.select("f", F.col("own").bitwiseXOR(F.col("cell")).alias("cell"))
    around = F.array(*[F.array(*map(F.lit, steps(radius, SEGMENTS - len(block)))) for block in BLOCKS])
    asks = grids.select(F.col("f").alias("g"), "own", "cell", F.explode(F.get(around, F.col("block"))).alias("step"))
    asks = asks.select("g", F.col("own").bitwiseXOR(F.col("cell") + F.col("step")).alias("cell"))
    # The planner does not see that rows multiply, and would broadcast a side by the size of its table.
    return at.hint("merge").join(asks, "cell").select("f", "g")


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a < b for every two of the distinct numbers in column f that differ in 1 to ``radius`` bits (2 at most)."""
    if not 0 < radius <= 2:
        raise ValueError("the cells leave room for a radius of 1 or 2")
    near = (F.col("f") != F.col("g")) & (F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius)
    return met(points, radius).where(near).select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b")).distinct()


def _grouped(docs: DataFrame, width: int, radius: int, id_col: str, text: str) -> DataFrame:
    """id, hash, f, root (of the component, a fingerprint), component_id (the least id), of every row."""
    rows = stored(fingerprints(docs, width, id_col, text), "fingerprints")
    least = stored(rows.groupBy("f").agg(F.min("id").alias("least")), "distinct")
    root = components(links(least, radius))
    of = least.join(root.select(F.col("node").alias("f"), "root"), "f", "left")
    of = of.select("f", "least", F.coalesce("root", "f").alias("root"))
    lowest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(of.join(lowest, "root").select("f", "root", "component_id"), "f")


def groups(docs: DataFrame, width: int = 3, radius: int = RADIUS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, fingerprint (16 hexadecimal digits), component_id.

    component_id is the least id that a chain of links reaches, the row's own included; equal
    fingerprints are linked. Texts without words (and null) have fingerprint 0 and are linked
    like any other. Null ids count for no component; a component of null ids only has none.
    Repeated rows repeat; other columns are not read.
    """
    return _grouped(docs, width, radius, id_col, text).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = RADIUS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component of ``groups``: that of the least id.

    Rows that share an id are one document where their texts fall into one component, and each text of
    a repeated id is judged by its own component. Rows without an id go where a document with one is in
    their component; of a component without ids the texts of the least fingerprint and hash stay.
    No text is shuffled but to drop it: what goes is told by id and hash.
    """
    found = _grouped(docs, width, radius, id_col, text)
    nameless = found.where("component_id is null").groupBy("root").agg(F.min(F.struct("f", "hash")).alias("first"))
    other = found.where("component_id is null").join(nameless, "root").where("struct(f, hash) <> first")
    gone = found.where("component_id is not null and not id <=> component_id").select("id", "hash")
    gone = gone.unionByName(other.select("id", "hash")).distinct().select(F.col("id").alias("_gone"), F.col("hash").alias("_text"))
    rows = docs.withColumn("_hash", _hash(docs[text]))
    dropped = rows[id_col].eqNullSafe(gone["_gone"]) & (rows["_hash"] == gone["_text"])
    return rows.join(gone, dropped, "left_anti").select(*docs.columns)
