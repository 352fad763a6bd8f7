"""Resolution of alignments to lineages: candidates, groups of equally good candidates, votes of members, and consensus caps.

A result is status, reason, taxid ('NA' where none stands for the lineage), ranks (seven
names), depth and origin ('DIRECT', or 'LCA' for the last common ranks of several).
Groups are settled by partial aggregates on minima, maxima and counts of names; only
the distinct reasons and identities of a group are gathered, never its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.lineages import NA, canonical_lineage, conflicts, cut_to, lineage_depth, lineage_text, one_sided
from tidewater.operators.ranking import best_with_ties

#: Statuses by which a group with any such member is named, the worst first. Fixed values.
BAD = ("REFERENCE_INCONSISTENT", "REFERENCE_UNRESOLVED")
NO_VOTE = (*BAD, "COMPUTATION_FAILED", "FILTERED_INELIGIBLE", "NO_HIT")
USABLE = ("ASSIGNED", "AMBIGUOUS_TIE")


def resolve_candidates(df: DataFrame, genus_from: float, species_from: float) -> DataFrame:
    """df with status, reason, resolved_taxid, ranks, depth, origin and identities, by the first rule that a candidate fails.

    Columns read: taxid (long; negative ones are configured), pident, kingdom (the target's), authority (ranks of a configured
    id; null: none), numeric (ranks of a positive id), titles (array of the reference titles' ranks; null: no title),
    wrong_marker, bad_title, memory (taxids of species, genus, family and order as text; null: none) and ancestors (map of
    a positive taxid to its ranks).
    """
    id_, tag = F.col("taxid"), lambda x: F.concat(F.col("taxid").cast("string"), F.lit(":" + x))
    ranks = F.when(id_ < 0, F.col("authority")).otherwise(F.coalesce("numeric", F.array_repeat(F.lit(NA), 7)))
    clash = F.array_distinct(F.flatten(F.transform(F.coalesce("titles", F.array().cast("array<array<string>>")), lambda t: conflicts(F.col("own"), t))))
    partial = F.exists(F.coalesce("titles", F.array().cast("array<array<string>>")), lambda t: F.size(one_sided(F.col("own"), t)) > 0)
    first = F.when(F.col("pident") < genus_from, 2).when(F.col("pident") < species_from, 1).otherwise(0)
    tier = F.array_min(F.filter(F.transform(F.col("memory"), lambda x, i: F.when((x != NA) & (i >= first), i)), lambda i: i.isNotNull()))
    df = df.withColumn("own", ranks).withColumn("tier", tier)
    df = df.withColumn("tier_taxid", F.get("memory", F.col("tier"))).withColumn("cut", cut_to("own", F.lit(6) - F.col("tier")))
    positive = lambda x: (x != NA) & ~x.startswith("-")
    above = F.try_element_at("ancestors", F.col("tier_taxid"))
    tier_depth = F.lit(6) - F.col("tier")
    reason = (
        F.when(F.coalesce("wrong_marker", F.lit(False)), tag("wrong_kingdom_or_marker"))
        .when(F.coalesce("bad_title", F.lit(False)), tag("malformed_reference_title"))
        .when(F.col("own").isNull(), tag("missing_marker_lineage"))
        .when(lineage_depth("own") < 0, tag("missing_lineage"))
        .when(F.col("own")[0] != F.col("kingdom"), tag("wrong_kingdom"))
        .when(F.size(clash) > 0, F.concat(tag("contradictory_populated_ranks:"), F.concat_ws(",", F.array_sort(clash).cast("array<string>"))))
        .when((id_ < 0) & F.col("titles").isNull(), tag("missing_deployed_validation"))
        .when(F.col("memory").isNull(), tag("missing_marker_memtax"))
        .when(F.col("tier").isNull(), tag("unresolved_identity_tier"))
        .when(lineage_depth("cut") < 0, tag("missing_tier_lineage"))
        .when((id_ < 0) & positive(F.col("tier_taxid")) & (above.isNull() | (F.get(above, tier_depth) == NA)), tag("missing_numeric_ancestor"))
        .when((id_ < 0) & positive(F.col("tier_taxid")) & (F.size(conflicts("cut", cut_to(above, tier_depth))) > 0), tag("contradictory_numeric_ancestor"))
    )
    inconsistent = F.col("bad").endswith(":wrong_kingdom_or_marker") | F.col("bad").endswith(":wrong_kingdom")

    def identity(i):  # of the rank that memory has at place i
        depth, taxid = 6 - i, F.get("memory", i)
        other = F.try_element_at("ancestors", taxid)
        sound = (taxid != NA) & (F.get("own", depth) != NA)
        valid = ~positive(taxid) | (other.isNotNull() & (F.get(other, depth) != NA) & (F.size(conflicts(cut_to("own", depth), cut_to(other, depth))) == 0))
        return F.when(sound & valid, F.struct(lineage_text(cut_to("own", depth)).alias("text"), taxid.alias("taxid")))

    places = F.sequence(F.lit(0), F.lit(3))
    unproven = F.filter(places, lambda i: positive(F.get("memory", i)) & (F.get("own", 6 - i) != NA) & identity(i).isNull())
    notes = F.concat(
        F.when(partial, F.array(tag("completeness_only"))).otherwise(F.array().cast("array<string>")),
        F.transform(unproven, lambda i: F.concat(tag("unvalidated_numeric_ancestor:"), F.get("memory", i))),
    )
    good = F.col("bad").isNull()
    df = df.withColumn("bad", reason)
    return df.select(
        *[c for c in df.columns if c not in ("own", "tier", "tier_taxid", "cut", "bad")],
        F.when(good, "ASSIGNED").when(inconsistent, BAD[0]).otherwise(BAD[1]).alias("status"),
        F.when(~good, F.col("bad")).when(F.size(notes) > 0, F.concat_ws(",", F.array_sort(F.array_distinct(notes)))).otherwise(NA).alias("reason"),
        F.when(good & (F.get("cut", tier_depth) != NA), F.col("tier_taxid")).otherwise(NA).alias("resolved_taxid"),
        F.when(good, F.col("cut")).alias("ranks"),
        F.when(good, lineage_depth("cut")).otherwise(-1).alias("depth"),
        F.when(good, "DIRECT").otherwise(NA).alias("origin"),
        F.when(good, F.filter(F.transform(places, identity), lambda x: x.isNotNull())).alias("identities"),
    )


def _rank_aggregates() -> list[Column]:
    names = [F.nullif(F.col("ranks")[i], F.lit(NA)) for i in range(7)]
    return [x for i, n in enumerate(names) for x in (F.min(n).alias(f"low_{i}"), F.max(n).alias(f"high_{i}"), F.count(n).alias(f"have_{i}"))]


def _common(n: Column) -> Column:
    """The last common ranks, from the aggregates over n results: down to the first rank on which names differ, without those that some miss."""
    open_, out = F.lit(True), []
    for i in range(7):
        open_ = open_ & F.coalesce(F.col(f"low_{i}") == F.col(f"high_{i}"), F.lit(True))
        out.append(F.when(open_ & (F.col(f"have_{i}") == n) & (n > 0), F.col(f"low_{i}")).otherwise(NA))
    return F.array(*out)


def _identity() -> Column:
    return F.concat_ws("\t", "resolved_taxid", lineage_text("ranks"))


def resolve_groups(resolved: DataFrame, keys: list[str]) -> DataFrame:
    """One result per key of the candidates that resolve_candidates gave; a row with a null taxid stands for a key without a hit.

    Any bad candidate names the group, the worst first; one identity is the result; several give their last common ranks. An
    NA taxid is no identity, so there the source taxids keep candidates apart.
    """
    mark = F.when(F.col("resolved_taxid") == NA, F.concat_ws("\t", _identity(), "taxid")).otherwise(_identity())
    hit = F.col("taxid").isNotNull()
    of = lambda s: F.array_sort(F.collect_set(F.when(hit & (F.col("status") == s), F.col("reason"))))
    grouped = resolved.groupBy(*keys).agg(
        F.count(F.when(hit, 1)).alias("n"),
        *[of(s).alias(s) for s in BAD],
        F.min(F.when(hit, mark)).alias("least"),
        F.max(F.when(hit, mark)).alias("most"),
        F.min(F.when(hit, F.struct("resolved_taxid", "ranks", "reason"))).alias("one"),
        F.array_sort(F.collect_set(F.when(F.col("reason") != NA, F.col("reason")))).alias("reasons"),
        F.array_distinct(F.flatten(F.collect_set("identities"))).alias("identities"),
        *_rank_aggregates(),
    )
    common = F.col("common")
    taxids = F.array_distinct(F.transform(F.filter("identities", lambda x: x["text"] == lineage_text(common)), lambda x: x["taxid"]))
    single, deep = F.col("least") == F.col("most"), lineage_depth(common) >= 0
    status = F.when(F.col("n") == 0, "NO_HIT")
    reason = F.when(F.col("n") == 0, "no_hit")
    for s in BAD:
        status, reason = status.when(F.size(s) > 0, s), reason.when(F.size(s) > 0, F.concat_ws(",", s))
    status = status.when(single, "ASSIGNED").when(deep, "AMBIGUOUS_TIE").otherwise(BAD[1])
    all_reasons = F.concat_ws(",", F.array_sort(F.concat(F.array(F.lit("lineage_lca")), "reasons")))
    reason = reason.when(single, F.col("one.reason")).when(deep, all_reasons).otherwise("no_common_lineage")
    done = grouped.withColumn("common", _common(F.col("n"))).withColumn("status", status).withColumn("reason", reason)
    lca = F.col("status") == "AMBIGUOUS_TIE"
    return done.select(
        *keys,
        "status",
        "reason",
        F.when(F.col("status") == "ASSIGNED", F.col("one.resolved_taxid")).when(lca & (F.size(taxids) == 1), taxids[0]).otherwise(NA).alias("resolved_taxid"),
        F.when(F.col("status") == "ASSIGNED", F.col("one.ranks")).when(lca, common).alias("ranks"),
        F.when(F.col("status") == "ASSIGNED", lineage_depth("one.ranks")).when(lca, lineage_depth(common)).otherwise(-1).alias("depth"),
        F.when(F.col("status") == "ASSIGNED", "DIRECT").when(lca, "LCA").otherwise(NA).alias("origin"),
    )


def vote(members: DataFrame, keys: list[str]) -> DataFrame:
    """One result per key by the members' identities (taxid and lineage) with most votes; a tie gives the winners' last common ranks."""
    usable = members.where(F.col("status").isin(*USABLE))
    counted = usable.withColumn("identity", _identity()).groupBy(*keys, "identity", "resolved_taxid", "ranks").agg(
        F.count("*").alias("support"), F.max((F.col("origin") == "LCA").cast("int")).alias("tied")
    )
    totals = counted.groupBy(*keys).agg(F.sum("support").alias("votes"))
    winners = best_with_ties(counted, keys, [F.desc("support")]).groupBy(*keys).agg(
        F.count("*").alias("winner_count"), F.max("support").alias("support"), F.max("tied").alias("tied"), F.min("resolved_taxid").alias("one"), F.min("ranks").alias("own"), *_rank_aggregates()
    )
    worst = reduce(lambda held, x: held.when(F.max((F.col("status") == x).cast("int")) == 1, x), NO_VOTE[1:], F.when(F.max((F.col("status") == NO_VOTE[0]).cast("int")) == 1, NO_VOTE[0]))
    every = members.groupBy(*keys).agg(F.count("*").alias("member_count"), worst.otherwise("NO_HIT").alias("worst"))
    done = every.join(winners.withColumn("common", _common(F.col("winner_count"))), keys, "left").join(totals, keys, "left")
    n, deep = F.coalesce("winner_count", F.lit(0)), lineage_depth("common") >= 0
    status = F.when(n == 0, F.col("worst")).when((n == 1) & (F.col("tied") == 0), "ASSIGNED").when((n == 1) | deep, "AMBIGUOUS_TIE").otherwise(BAD[1])
    return done.select(
        *keys,
        status.alias("status"),
        F.when(n == 0, "no_usable_votes").when(n == 1, "plurality").when(deep, "lineage_lca").otherwise("no_common_lineage").alias("reason"),
        F.when(n == 1, F.col("one")).otherwise(NA).alias("resolved_taxid"),
        F.when(n == 1, F.col("own")).when((n > 1) & deep, F.col("common")).alias("ranks"),
        F.when(n == 1, lineage_depth("own")).when(n > 1, lineage_depth("common")).otherwise(-1).alias("depth"),
        F.when((n == 1) & (F.col("tied") == 0), "DIRECT").when((n == 1) | ((n > 1) & deep), "LCA").otherwise(NA).alias("origin"),
        F.coalesce("votes", F.lit(0)).alias("votes"),
        F.coalesce("support", F.lit(0)).alias("support"),
        n.alias("winner_count"),
        "member_count",
    )


def contract(members: DataFrame, evidence: DataFrame, read: str, clusters: list[str]) -> DataFrame:
    """The marker contract: each member (read, clusters) with its own result, and its cluster's vote beside it as cluster_*."""
    own = members.join(evidence, read, "left").withColumn("status", F.coalesce("status", F.lit("NO_HIT"))).withColumn("depth", F.coalesce("depth", F.lit(-1)))
    voted = vote(own, clusters)
    names = [x for x in voted.columns if x not in clusters]
    return own.join(voted.select(*clusters, *[F.col(x).alias(f"cluster_{x}") for x in names]), clusters, "left")


def cap_by_identity(df: DataFrame, family_from: float, genus_from: float, species_from: float) -> DataFrame:
    """Consensus results cut at the deepest rank that the identity allows (species, genus, family, else order).

    A cut that is shallower than allowed, or at the order, keeps a taxid only where just one identity stands for it.
    """
    cap = F.when(F.col("pident") >= species_from, 6).when(F.col("pident") >= genus_from, 5).when(F.col("pident") >= family_from, 4).otherwise(3)
    df = df.withColumn("cap", cap).withColumn("ranks", F.when(F.col("status").isin(*USABLE), cut_to("ranks", F.col("cap"))))
    depth = lineage_depth("ranks")
    taxids = F.array_distinct(F.transform(F.filter("identities", lambda x: x["text"] == lineage_text("ranks")), lambda x: x["taxid"]))
    lost = F.col("status").isin(*USABLE) & (depth < 0)
    told = F.when(lost, NA).when((depth < F.col("cap")) | (F.col("cap") == 3), F.when(F.size(taxids) == 1, taxids[0]).otherwise(NA)).otherwise(F.col("resolved_taxid"))
    return (
        df.withColumn("resolved_taxid", told)
        .withColumn("depth", F.when(F.col("ranks").isNull(), -1).otherwise(depth))
        .withColumn("reason", F.when(lost, "no_usable_rank").otherwise(F.col("reason")))
        .withColumn("status", F.when(lost, BAD[1]).otherwise(F.col("status")))
    )


def configured_authority(rows: DataFrame, kingdom: str) -> DataFrame:
    """taxid, authority (ranks or null) and authority_reason of configured lineages (taxid, lineage) within one kingdom."""
    parsed = rows.select("taxid", canonical_lineage("lineage").alias("r"))
    bad = F.max((F.col("r").isNull() | (F.col("r")[0] == NA)).cast("int"))
    own = F.when(F.col("r")[0] == kingdom, F.col("r"))
    held = parsed.groupBy("taxid").agg(bad.alias("bad"), F.min(own).alias("low"), F.max(own).alias("high"))
    reason = F.when(F.col("bad") == 1, "malformed_configured_lineage").when(F.col("low").isNull(), "missing_marker_lineage").when(F.col("low") != F.col("high"), "conflicting_marker_lineages")
    return held.select("taxid", F.when(reason.isNull(), F.col("low")).alias("authority"), F.coalesce(reason, F.lit(NA)).alias("authority_reason"))


def rank_memory(needed: DataFrame, seed: DataFrame, known: DataFrame) -> DataFrame:
    """taxid and memory (species, genus, family, order taxids): ids that are not positive come from the seed alone, all NA where it has none."""
    na = F.array(*[F.lit(NA)] * 4)
    both = needed.select("taxid").distinct().join(seed.select("taxid", F.col("memory").alias("seeded")), "taxid", "left").join(known.select("taxid", F.col("memory").alias("learned")), "taxid", "left")
    return both.select("taxid", F.when(F.col("taxid") <= 0, F.coalesce("seeded", na)).otherwise(F.col("learned")).alias("memory"))
