"""Sinks that may be run again: a round replaces its own rows and no others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_round(df: DataFrame, path: str, round_column: str = "round") -> None:
    """Adds or replaces the partitions of the rounds in df."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(round_column).parquet(path)


def upsert(history: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """history without the keys of new, and new."""
    return history.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def to_fasta(df: DataFrame, id_: str = "id", seq: str = "seq") -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(id_), F.lit("\n"), F.col(seq)).alias("value"))
