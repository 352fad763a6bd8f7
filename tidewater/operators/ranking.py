"""Argmax and top-k with stated tie rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by a total order."""
    return df.withColumn("_nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def best_with_ties(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """All rows per key that are equal to the first by order."""
    return df.withColumn("_place", F.rank().over(W.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


def best_hsps(hsps: DataFrame) -> DataFrame:
    """The best alignment per (hash, subject), then every subject whose alignment equals the hash's best."""
    order = [F.desc("bitscore"), F.asc("evalue"), F.desc("length"), F.desc("pident")]
    return best_with_ties(best_by(hsps, ["hash", "subject"], [*order, F.asc("ordinal")]), ["hash"], order)


def until_quota(df: DataFrame, keys: list[str], order: list[Column], count: str, quota: int) -> DataFrame:
    """The shortest run of rows, in order, whose counts reach the quota (all rows where they do not)."""
    before = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(count).over(before), F.lit(0))).where(F.col("_before") < quota).drop("_before")
