"""State over rounds in batch form: each takes rows with a round number and key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def streaks(df: DataFrame, keys: list[str], round_: str = "round") -> DataFrame:
    """Adds ``streak``: how many rounds in a row, up to this one, the key is present. Absence resets it."""
    order = W.partitionBy(*keys).orderBy(round_)
    island = F.col(round_) - F.row_number().over(order)
    marked = df.withColumn("_island", island)
    run = W.partitionBy(*keys, "_island").orderBy(round_)
    return marked.withColumn("streak", F.row_number().over(run).cast("long")).drop("_island")


def promotions(df: DataFrame, keys: list[str], count: str, rounds: int = 3, reads: int = 50, window: int = 3, drop: float = 0.25) -> DataFrame:
    """Per key: rounds seen, reads, and whether it is promoted.

    That needs enough rounds and reads, and over the last ``window`` rounds of a key with so many no count under
    (1 - drop) of a count before it that is not zero.
    """
    order = W.partitionBy(*keys).orderBy("round")
    back = W.partitionBy(*keys).orderBy(F.desc("round"))
    steps = df.select(*keys, "round", count, F.lag(count).over(order).alias("_before"), F.row_number().over(back).alias("_back"))
    fell = (F.col("_back") < window) & (F.col("_before") > 0) & (F.col(count) < (1 - drop) * F.col("_before"))
    out = steps.groupBy(*keys).agg(F.count("*").alias("rounds"), F.sum(count).cast("long").alias("reads"), F.max(F.when(fell, 1).otherwise(0)).alias("_fell"))
    steady = (F.col("rounds") < window) | (F.col("_fell") == 0)
    return out.select(*keys, "rounds", "reads", ((F.col("rounds") >= rounds) & (F.col("reads") >= reads) & steady).alias("promoted"))


def first_seen(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key over all rounds."""
    return df.withColumn("_nth", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_nth = 1").drop("_nth")


def all_or_null(value: str) -> Column:
    """The sum over a group, null if any row lacks the value."""
    return F.when(F.count(value) == F.count("*"), F.sum(value))
