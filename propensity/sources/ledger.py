"""Run ledger: parameters, metrics and summaries as append-only parquet tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run string, name string, started timestamp, summary string"
PARAMS = "run string, key string, value string"
METRICS = "run string, key string, value double, step int"


class RunLedger:
    """A few rows per run; several writers may append at once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _append(self, table: str, rows: list[tuple], schema: str) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{table}")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def start(self, name: str, summary: Mapping[str, object] | None = None) -> str:
        run = uuid.uuid4().hex
        text = json.dumps(dict(summary or {}), default=str, sort_keys=True)
        self._append("runs", [(run, name, datetime.now(timezone.utc), text)], RUNS)
        return run

    def append(self, run: str, params: Mapping[str, object] | None = None,
               metrics: Mapping[str, float] | None = None, step: int | None = None) -> None:
        """Parameters are kept as text, metrics as doubles with an optional step."""
        self._append("params", [(run, k, str(v)) for k, v in (params or {}).items()], PARAMS)
        self._append("metrics", [(run, k, float(v), step) for k, v in (metrics or {}).items()], METRICS)

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS)

    def params(self) -> DataFrame:
        return self._read("params", PARAMS)

    def metrics(self) -> DataFrame:
        return self._read("metrics", METRICS)

    def best(self, metric: str) -> DataFrame:
        """The run with the highest value of a metric; the run id breaks ties."""
        return best_run(self.metrics(), metric)


def best_run(metrics: DataFrame, metric: str) -> DataFrame:
    mine = metrics.where(F.col("key") == metric)
    return mine.agg(F.max_by("run", F.struct("value", "run")).alias("run"), F.max("value").alias("value"))


def last_values(metrics: DataFrame) -> DataFrame:
    """The value of the highest step per run and metric."""
    return metrics.groupBy("run", "key").agg(F.max_by("value", F.coalesce("step", F.lit(-1))).alias("value"))
