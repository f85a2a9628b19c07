"""Hashed text features of many texts at once, as numpy arrays over their code points."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.texts import mix32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    size = 1 << bits
    up, down = np.full(size, _ODD), np.full(size, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Points:
    """Code points of texts laid end to end, each between two line ends."""

    def __init__(self, texts: list[str]):
        self.code = np.frombuffer(("\n" + "\n\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) + 2 for t in texts], np.int64)
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.space = (self.code == 32) | ((self.code >= 9) & (self.code <= 13))

    def lowered(self) -> np.ndarray:
        upper = (self.code >= 65) & (self.code <= 90)
        return self.code + (upper * np.uint32(32)).astype(np.uint32)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of true; a run never crosses texts, as a line end is outside."""
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        return edge[::2], edge[1::2]

    def run_hashes(self, code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """32-bit hashes of the runs [start, end) of ``code``."""
        up, down = _powers(max(1, int(len(code)).bit_length()))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up[:len(code)])))
        h = (total[ends] - total[starts]) * down[starts]
        return mix32((h >> np.uint64(32)).astype(np.uint32) ^ (h & np.uint64(0xFFFFFFFF)).astype(np.uint32))

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, "right")


def sampled(docs: DataFrame, labels: DataFrame, label: str, rows: int, parts: int, left_out: int,
            id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text and label of at most ``rows`` labelled documents to learn from, one row for each id.

    Documents whose crc32 of the id (as text) leaves ``left_out`` modulo ``parts`` are never among
    them. The rows are those of the lowest hashes of the ids that are among ``docs``, so the choice does
    not depend on the order of the input. Labels other than 0 and 1 and null ids are left out; of repeated labels of an id
    the highest holds, of its texts the least (null counts as empty).
    """
    marks = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
             .where(~held_out(F.col(id_col), parts, left_out))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label")))
    present = docs.select(docs[id_col].alias("id")).distinct()
    marks = marks.join(present, "id").orderBy(F.xxhash64("id"), "id").limit(rows)
    given = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    given = given.join(F.broadcast(marks), "id")  # at most ``rows`` short rows
    return given.groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


def held_out(column, parts: int, left_out: int):
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts == left_out, F.lit(False))
