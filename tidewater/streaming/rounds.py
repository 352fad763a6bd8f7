"""Rounds as micro-batches: each batch is written once under its number, whatever is repeated after a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.sinks import write_round


def watch(spark: SparkSession, folder: str, schema: str, format_: str = "parquet", files_per_round: int = 1) -> DataFrame:
    """A stream of the files in a folder, at most so many a round; files already taken are not taken again."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_round).format(format_).load(folder)


def run_rounds(stream: DataFrame, out: str, checkpoint: str, work=lambda batch: batch) -> None:
    """Apply work to each round and write its rows to out, partitioned by round, until no file is left."""

    def one(batch: DataFrame, number: int) -> None:
        write_round(work(batch).withColumn("round", F.lit(number)), out)

    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(stream: DataFrame, key: str) -> DataFrame:
    """Only the first row of each key over all rounds, by keyed state."""
    return stream.dropDuplicates([key])
