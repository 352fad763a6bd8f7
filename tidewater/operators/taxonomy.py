"""Lineage consensus and votes over rank arrays (broadest rank first, null where missing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ranking import best_with_ties


def known(name: Column) -> Column:
    """Null for a blank, NA or unassigned name."""
    trimmed = F.regexp_replace(F.coalesce(name, F.lit("")), r"^\s+|\s+$", "")
    return F.when(~F.lower(trimmed).isin("", "na", "unassigned"), trimmed)


def common_lineage(df: DataFrame, keys: list[str], ranks: list[str], identity: list[str] | None = None) -> DataFrame:
    """Per key the ranks on which all rows agree, down to the first that two names contest; and depth, the last such rank (-1: none).

    A rank is set only where every row has it and all are equal; a rank that some rows miss is null but does not end the walk.
    Rows that are equal in ``identity`` (the ranks, unless named) are one result, and a key with one result is ASSIGNED. The
    aggregates are minima, maxima and counts, so a key's rows are never gathered and no row is expanded.
    """
    one = F.struct(*(identity or ranks))
    counts = [x for r in ranks for x in (F.min(r).alias(r), F.max(r).alias(f"_m_{r}"), F.count(r).alias(f"_k_{r}"))]
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_all"), F.min(one).alias("_low"), F.max(one).alias("_high"), *counts)
    open_, out, depth = F.lit(True), [], F.lit(-1)
    for place, rank in enumerate(ranks):
        open_ = open_ & F.coalesce(F.col(rank) == F.col(f"_m_{rank}"), F.lit(True))
        agreed = open_ & (F.col(f"_k_{rank}") == F.col("_all"))
        out.append(F.when(agreed, F.col(rank)).alias(rank))
        depth = F.when(agreed, place).otherwise(depth)
    status = F.when(F.col("depth") < 0, "REFERENCE_UNRESOLVED").when(F.col("_single"), "ASSIGNED").otherwise("AMBIGUOUS_TIE")
    done = grouped.select(*keys, F.col("_low").eqNullSafe(F.col("_high")).alias("_single"), *out, depth.cast("long").alias("depth"))
    return done.select(*keys, *ranks, "depth", status.alias("status"))


def identity_tier(pident: Column, genus: float, species: float, ranks: dict[str, Column]) -> Column:
    """The deepest known name that the identity allows."""
    family, genus_name, species_name = ranks["family"], ranks["genus"], ranks["species"]
    return F.when(pident < genus, family).when(pident < species, F.coalesce(genus_name, family)).otherwise(F.coalesce(species_name, genus_name, family))


def plurality(df: DataFrame, keys: list[str], ranks: list[str], identity: list[str] | None = None) -> DataFrame:
    """Per key the lineage with most rows: ASSIGNED where it is the only one with so many, else the winners' common ranks; with votes and winners.

    Rows without any name do not vote.
    """
    known_row = F.coalesce(*ranks).isNotNull()
    counted = df.where(known_row).groupBy(*keys, *dict.fromkeys([*(identity or ()), *ranks])).agg(F.count("*").alias("votes"))
    winners = best_with_ties(counted, keys, [F.desc("votes")])
    common = common_lineage(winners, keys, ranks, identity)
    return common.join(winners.groupBy(*keys).agg(F.max("votes").alias("votes"), F.count("*").alias("winners")), keys)

