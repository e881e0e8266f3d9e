"""Staged intermediates: Parquet in the folder all executors share.

A result that several later steps read is written once and read back. That cuts lineage, lets each
reader prune columns, and survives the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from starsmelt.sources.folders import remove
from starsmelt.sources.parquet import CODEC

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local master may do without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="starsmelt-")
    return _LOCAL_FOLDERS[application]


class Stage:
    """A fresh folder for the staged results of one run; as a context, removed at the end of it."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/starsmelt-{uuid.uuid4().hex}"

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *failure) -> None:
        remove(self.spark, self.folder)

    def path(self, name: str) -> str:
        """A folder of its own for each call, so nothing staged is ever overwritten."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, path: str) -> None:
        df.write.option("compression", CODEC).parquet(path)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to a fresh folder and return a scan of what was written."""
        path = self.path(name)
        self.write(df, path)
        return self.spark.read.schema(df.schema).parquet(path)
