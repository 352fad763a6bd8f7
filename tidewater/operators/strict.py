"""Joins and checks that fail closed: they raise ValueError with some of the rows that break the rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_none(violations: DataFrame, rule: str, show: int = 5) -> None:
    """Raise if there is any row."""
    found = violations.limit(show).collect()
    if found:
        raise ValueError(f"{rule}: " + "; ".join(str(x.asDict()) for x in found))


def require_unique(df: DataFrame, keys: list[str], rule: str) -> None:
    require_none(df.groupBy(*keys).count().where("count > 1"), rule)


def strict_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join of two tables that must hold the same keys, each once."""
    for side in (left, right):
        require_unique(side, keys, "repeated key")
    require_none(left.select(*keys).join(right.select(*keys), keys, "left_anti"), "key without a partner on the right")
    require_none(right.select(*keys).join(left.select(*keys), keys, "left_anti"), "key without a partner on the left")
    return left.join(right, keys)


def membership_parity(members: DataFrame, sidecar: DataFrame, keys: list[str]) -> DataFrame:
    """members with the sidecar's columns; a pair that only one of them has, or that repeats, is fatal."""
    return strict_join(members, sidecar, keys)


def frozen_representatives(meta: DataFrame, hashes: DataFrame) -> DataFrame:
    """One representative row per hash of meta; hashes (uuid, hash) and meta (hash, rep) must map one to one."""
    require_unique(meta, ["hash"], "hash with several representatives")
    require_unique(meta, ["rep"], "representative of several hashes")
    require_none(meta.join(hashes.withColumnRenamed("uuid", "rep"), ["rep", "hash"], "left_anti"), "representative whose own hash differs")
    return meta.join(hashes.select("hash").distinct(), "hash", "left_semi")


def dispositions(references: DataFrame, policy: DataFrame) -> DataFrame:
    """references with action ('retain' without a policy); a repeated or unused disposition and an unknown action are fatal."""
    require_unique(policy, ["reference"], "repeated disposition")
    require_none(policy.where("action not in ('quarantine', 'retain') or action is null"), "unknown action")
    require_none(policy.join(references, "reference", "left_anti"), "disposition of no reference")
    return references.join(policy, "reference", "left").withColumn("action", F.coalesce("action", F.lit("retain")))


def release_dispositions(audit: DataFrame, policy: DataFrame, keys: tuple[str, ...] = ("tier", "status")) -> DataFrame:
    """audit with the policy's columns for its tier and status; a row whose pair the policy does not name is fatal."""
    require_unique(policy, list(keys), "repeated policy")
    require_none(audit.join(policy, list(keys), "left_anti"), "unmapped row")
    return audit.join(policy, list(keys))


def split_parents(reads: DataFrame) -> DataFrame:
    """reads (read_id, marker, parent) without the (read, marker) pairs that a split child names as its parent; a child with two parents is fatal."""
    known = reads.where("parent is not null")
    require_none(known.groupBy("read_id").agg(F.min("parent").alias("a"), F.max("parent").alias("b")).where("a <> b"), "child with several parents")
    return reads.join(known.select(F.col("parent").alias("read_id"), "marker").distinct(), ["read_id", "marker"], "left_anti")


def base_id_map(members: DataFrame, hashes: DataFrame, legacy: bool) -> DataFrame:
    """members (read_id, base_id) with hash, by exact id, else in legacy mode by base id; a base id with several hashes is fatal if used."""
    exact = members.join(hashes.select(F.col("id").alias("read_id"), F.col("hash").alias("exact")), "read_id", "left")
    if not legacy:
        return exact.withColumnRenamed("exact", "hash")
    bases = hashes.groupBy("base_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    both = exact.join(bases, "base_id", "left")
    require_none(both.where("exact is null and low <> high"), "ambiguous base id")
    return both.withColumn("hash", F.coalesce("exact", "low")).drop("exact", "low", "high")


def conservation(df: DataFrame, total: str, parts: list[str]) -> DataFrame:
    """Rows whose parts do not add up to their total; rows with any null are not judged."""
    known = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in (total, *parts)])
    return df.where(known & (F.col(total) != reduce(lambda a, b: a + b, [F.col(x) for x in parts])))


def stage_order(df: DataFrame, stages: list[str]) -> DataFrame:
    """Rows where a later stage counts more than an earlier one."""
    return df.where(reduce(lambda a, b: a | b, [F.col(b) > F.col(a) for a, b in zip(stages, stages[1:])]))


def not_a_partition(universe: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """Keys of the universe that are in no part or in several, and keys of parts that are not in it: key, parts."""
    every = reduce(DataFrame.union, [p.select(key).distinct().withColumn("one", F.lit(1)) for p in parts])
    held = every.groupBy(key).agg(F.sum("one").alias("parts"))
    both = universe.select(F.col(key)).distinct().withColumn("inside", F.lit(True)).join(held, key, "full")
    return both.where("inside is null or parts is null or parts <> 1").select(key, F.coalesce("parts", F.lit(0)).alias("parts"))


def aggregate_mismatches(detail: DataFrame, summary: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Keys whose summary count is not the number of detail rows."""
    found = detail.groupBy(*keys).agg(F.count("*").alias("found"))
    both = summary.select(*keys, count).join(found, keys, "full").withColumn("found", F.coalesce("found", F.lit(0)))
    return both.where(F.coalesce(count, F.lit(-1)) != F.col("found"))


def marker_unit_mismatches(rows: DataFrame, units: DataFrame) -> DataFrame:
    """rows (unit, marker) whose unit is mapped to another marker; a unit with two markers in units is fatal."""
    require_none(units.groupBy("unit").agg(F.min("marker").alias("a"), F.max("marker").alias("b")).where("a <> b"), "unit with several markers")
    return rows.join(units.distinct().withColumnRenamed("marker", "expected"), "unit").where("marker <> expected")
