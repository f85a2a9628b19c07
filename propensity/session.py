"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "propensity", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tested under.

    On a cluster the submitter's configuration wins: nothing here sets memory or
    partition counts unless the caller passes them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="propensity-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for written intermediate tables, under ``spark.checkpoint.dir``.

    The cluster names a folder there that all its machines share. Where it is unset, only a
    session whose executors run in the driver (``local``) gets a temporary folder of the machine;
    any other is refused, as each executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/propensity/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the work folder and read back.

    Cuts the lineage of a frame that many later jobs read. A lost executor then costs a
    re-read, and later scans see parquet statistics and read only their columns.
    """
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)
