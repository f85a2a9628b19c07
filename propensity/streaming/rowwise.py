"""Apply row-wise operators to files as they arrive.

Feature sets, encoders and model scoring hold no state and do not look at other rows, so
the same functions serve batch and stream. Nothing here windows, joins or remembers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def write_new(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str,
              checkpoint: str) -> StreamingQuery:
    """Process all files not seen before, append the results and stop. Restarts resume."""
    return (transform(stream).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
