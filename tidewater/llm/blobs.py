"""Raw binary files written and read through Spark's own file sources.

Each row of ``write_blobs`` becomes one file: its bytes followed by ``trailer``.
The text writer passes the bytes of a string through unchanged, so any file
system that Spark can open will do, and Spark's committer keeps files of lost or
repeated tasks out of the result. The trailer is part of the caller's format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_blobs(df: DataFrame, column: str, path: str, trailer: str) -> None:
    (
        df.select(F.col(column).cast("string").alias("value"))
        .write.option("lineSep", trailer)
        .option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .text(path)
    )


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """Column content, one row a file; the empty files of empty tasks are left out."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of df has it."""
    held = {x.lower() for x in df.columns}
    while name.lower() in held:
        name = "_" + name
    return name


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts reach Python at most ``rows`` at a time, in this session, unless it already asks for fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)
