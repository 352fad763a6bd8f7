"""Shared working storage: everything written here is visible to the driver and to every executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where it is unset (tests, a laptop) a new local one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context._jsc.sc().getCheckpointDir()
        named = named.get() if named.isDefined() else None
    if not named:
        named = "file://" + tempfile.mkdtemp(prefix="tidewater-")
        context.setCheckpointDir(named)
    return named


class Workspace:
    """A private sub-folder of the shared folder for one run of an operator.

    ``table`` writes a DataFrame and reads it back, which cuts the lineage at a
    replicated copy: a lost executor costs a re-read, not a recomputation.
    ``drop`` removes what a later table has made obsolete.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, label: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{label}"

    def table(self, df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = self.path(label)
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, *paths: str) -> None:
        jvm = self.spark._jvm
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def stated_bytes(df: DataFrame) -> int:
    """The optimizer's own size estimate, in bytes; it costs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def tasks_for(df: DataFrame, bytes_each: int = 48 << 20) -> int:
    """Partitions that keep each near bytes_each of stored input, never fewer than the session's shuffle width."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = stated_bytes(df)
    return max(width, min(1_000_000, -(-size // bytes_each))) if size < 1 << 60 else width
