"""What the text operators share: reading a table, mapping batches, counting a memo's size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The six ASCII white space characters, as a class of Java, Python and DuckDB patterns.
SPACE = r"[\x20\x09-\x0D]"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def map_batches(df: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
                schema: str | StructType) -> DataFrame:
    """``work()`` runs once in each task and gives the function for its batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = work()
        for batch in batches:
            out = each(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def pieces(texts: list[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Slices of ``texts`` with about ``limit`` characters each, so that arrays stay small."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class Memo(dict):
    """Results by key, made at the first look-up; emptied when it holds ``limit`` entries."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def mix32(values: np.ndarray) -> np.ndarray:
    """Spread uint32 values over all bits."""
    values = values ^ (values >> np.uint32(16))
    values = values * np.uint32(0x7FEB352D)
    values = values ^ (values >> np.uint32(15))
    values = values * np.uint32(0x846CA68B)
    return values ^ (values >> np.uint32(16))


@contextmanager
def filtered_joins(spark: SparkSession):
    """Within it, Spark may drop rows by a Bloom filter of the other, smaller side before a shuffle.

    Spark builds the filter by itself, of bounded size, where that side is small enough by its own
    settings; here the least size of the large side is lowered. Results are the same either way.
    """
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)
