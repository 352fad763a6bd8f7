"""State over rounds: streaks, locks, pruning policies, pools and fates, each one round's step from the state before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.functions.scalars import base_read_id, header_model, is_no_adapter, keyed_token, model_rank
from tidewater.operators.strict import require_none


def streak_step(keys: DataFrame, state: DataFrame, rounds: int) -> DataFrame:
    """The next state (key, streak, due): a key of this round goes on from its streak, any other key is forgotten."""
    after = keys.select("key").distinct().join(state.select("key", F.col("streak").alias("before")), "key", "left")
    streak = F.coalesce("before", F.lit(0)) + 1
    return after.select("key", streak.alias("streak"), (streak >= rounds).alias("due"))


def unassigned_streak(members: DataFrame, assigned: DataFrame, state: DataFrame, low: int, high: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """The next state, and the reads to prune, of OTUs of low to high members that are not assigned.

    members: otu, uuid, ordinal and key (null where the hash map has none). An OTU's key is that of its first member with one;
    OTUs without a key are not tracked.
    """
    sized = members.groupBy("otu").agg(F.countDistinct("uuid").alias("size"), F.min_by("key", F.when(F.col("key").isNotNull(), F.col("ordinal"))).alias("key"))
    tracked = sized.where(F.col("size").between(low, high) & F.col("key").isNotNull()).join(assigned, "otu", "left_anti")
    after = streak_step(tracked, state, rounds)
    due = tracked.join(after.where("due"), "key", "left_semi")
    return after, members.join(due, "otu", "left_semi").select("uuid").distinct()


def size_streak(sizes: DataFrame, vetoed: DataFrame, state: DataFrame, min_members: int, rounds: int) -> DataFrame:
    """The next state of OTUs (key, size) under min_members that no eligible consensus vetoes; a key with several sizes is ambiguous and not tracked."""
    plain = sizes.groupBy("key").agg(F.min("size").alias("size"), F.max("size").alias("other")).where("size = other")
    return streak_step(plain.where(F.col("size") < min_members).join(vetoed, "key", "left_anti"), state, rounds)


def lock_rule(clusters: DataFrame, mode: str, min_qscore: float, min_reads: int, ratio: float = 0.0, pool_share: float = 0.0, top_share: float = 0.0, gap_ratio: float = 0.0, gap_reads: int = 0) -> DataFrame:
    """Per otu whether its clusters (hash, qscore, n, ordinal) pass, and how many are significant.

    'ratio': the largest cluster under the floor is at most ratio times the smallest over it. 'share': some cluster over
    the floor has these shares of all reads and of the largest such cluster. 'gap': the largest over the floor leads the
    next one of sufficient quality by ratio and reads. The floor is min_qscore and min_reads; shares and ratios have six places.
    """
    good = F.coalesce(F.col("qscore") >= min_qscore, F.lit(False))
    floor = good & (F.col("n") >= min_reads)
    rows = clusters.select("otu", "hash", "n", "ordinal", good.alias("good"), floor.alias("floor"))
    if mode == "ratio":
        held = rows.groupBy("otu").agg(F.min(F.when(F.col("floor"), F.col("n"))).alias("least"), F.coalesce(F.max(F.when(~F.col("floor"), F.col("n"))), F.lit(0)).alias("most"), F.count(F.when(F.col("floor"), 1)).alias("significant"))
        return held.select("otu", F.coalesce(F.col("most") <= F.round(F.lit(ratio) * F.col("least"), 6), F.lit(False)).alias("passes"), "significant")
    top = F.max_by("hash", F.when(F.col("floor"), F.struct("n", -F.col("ordinal"))))
    sums = rows.groupBy("otu").agg(F.sum("n").alias("pool"), F.max(F.when(F.col("floor"), F.col("n"))).alias("top"), top.alias("leader"))
    both = rows.join(sums, "otu")
    if mode == "share":
        over = F.col("floor") & (F.round(F.col("n") / F.col("pool"), 6) >= pool_share) & (F.round(F.col("n") / F.col("top"), 6) >= top_share)
        counted = both.groupBy("otu").agg(F.count(F.when(over, 1)).alias("significant"))
        return counted.select("otu", (F.col("significant") > 0).alias("passes"), "significant")
    if mode != "gap":
        raise ValueError(f"unknown rule {mode}")
    second = both.groupBy("otu").agg(F.first("top").alias("top"), F.max(F.when(F.col("good") & (F.col("hash") != F.col("leader")), F.col("n"))).alias("next"))
    leads = F.col("next").isNull() | ((F.round(F.col("top") / F.col("next"), 6) >= gap_ratio) & (F.col("top") - F.col("next") >= gap_reads))
    passes = F.col("top").isNotNull() & leads
    return second.select("otu", passes.alias("passes"), passes.cast("long").alias("significant"))


def lock_step(rule: DataFrame, frozen: DataFrame, state: DataFrame, rounds: int) -> DataFrame:
    """otu, passes, stable (passes in a row), consolidated (now, or before: that sticks). state: otu, passes, stable, consolidated."""
    held = rule.join(frozen.select("otu", F.lit(True).alias("frozen")), "otu", "left")
    held = held.join(state.select("otu", F.col("passes").alias("p"), F.col("stable").alias("s"), F.col("consolidated").alias("c")), "otu", "left")
    passes = F.coalesce("frozen", F.lit(False)) & F.col("passes") & (F.col("significant") > 0)
    stable = F.when(passes, F.when(F.coalesce("p", F.lit(False)), F.col("s") + 1).otherwise(1)).otherwise(0)
    return held.select("otu", passes.alias("passes"), stable.alias("stable"), (F.coalesce("c", F.lit(False)) | (passes & (stable >= rounds))).alias("consolidated"))


def prune_policy(policy: str, pool_mb: float, force_over_mb: float, override: bool, any_consolidated: bool) -> str:
    """The policy of this round: a pool over its size limit forces 'until_consolidated', unless 'never' is not to be overridden or nothing is consolidated."""
    if policy not in ("never", "always", "until_consolidated"):
        raise ValueError(f"unknown policy {policy}")
    forced = force_over_mb > 0 and pool_mb > force_over_mb and (policy != "never" or override) and any_consolidated
    return "until_consolidated" if forced else policy


def frozen_prune_ids(policy: str, frozen: DataFrame, pool: DataFrame, consolidated: DataFrame, by_sample: bool) -> DataFrame:
    """read_id of the reads to archive: all frozen members, those of consolidated keys (with or without the sample), or none."""
    if policy == "always":
        return frozen.select(base_read_id("header").alias("read_id")).where("read_id <> ''").distinct()
    if policy == "never":
        return pool.select("read_id").limit(0)
    keys = ["sample", "otu"] if by_sample else ["otu"]
    return pool.join(consolidated.select(*keys).distinct(), keys, "left_semi").select("read_id").distinct()


def unassigned_prune_status(mode, round_index, grace: int) -> Column:
    """mode_off, grace, observe or applied."""
    return F.when(mode == "off", "mode_off").when(round_index <= grace, "grace").when(mode == "observe", "observe").otherwise("applied")


def rolling_pool(pool: DataFrame, fresh: DataFrame) -> DataFrame:
    """Both pools (header, ordinal), one row per read: the best model, of equals the first, old before new."""
    every = pool.withColumn("age", F.lit(0)).unionByName(fresh.withColumn("age", F.lit(1)))
    every = every.withColumn("read_id", base_read_id("header")).withColumn("rank", model_rank(header_model("header")))
    order = W.partitionBy("read_id").orderBy(F.desc("rank"), "age", "ordinal", "header")
    return every.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("read_id", "header")


def fingerprint(df: DataFrame, columns: list[str]) -> str:
    """A text that is the same for the same rows in any order: their count and two sums of hashes."""
    sums = [F.sum(F.xxhash64(F.lit(k), *columns).cast("decimal(38,0)")) for k in (1, 2)]
    return "|".join(str(x) for x in df.agg(F.count("*"), *sums).first())


def unchanged(df: DataFrame, columns: list[str], before: str | None) -> tuple[bool, str]:
    """Whether the table is as it was, and its fingerprint to keep."""
    now = fingerprint(df, columns)
    return now == before, now


def frozen_snapshot(promoted: DataFrame, members: DataFrame, policy: str) -> DataFrame:
    """key and uuid of the members of promoted OTUs: by stable key ('strict': all must have one), display key ('legacy'), or either ('mixed')."""
    held = members.join(promoted.select("otu").distinct(), "otu", "left_semi")
    if policy == "strict":
        require_none(held.where("stable_key is null"), "promoted member without a stable key")
    key = {"strict": F.col("stable_key"), "legacy": F.col("otu"), "mixed": F.coalesce("stable_key", "otu")}[policy]
    return held.select(key.alias("key"), "uuid").distinct()


def fate_of_otus(active: DataFrame, blast_grace: bool, size_applied: bool, size_grace: bool) -> DataFrame:
    """otu and fate, one of four: blast_unassigned, size_streak, prune_candidates (would be pruned but for a grace) or informative_dynamic.

    active: otu, seen (has alignments), assigned, size_due; the rules go in that order.
    """
    seen = F.coalesce("seen", F.lit(False)) & ~F.coalesce("assigned", F.lit(False))
    size = "size_streak" if size_applied and not size_grace else "prune_candidates"
    fate = F.when(seen, "prune_candidates" if blast_grace else "blast_unassigned").when(F.coalesce("size_due", F.lit(False)), size).otherwise("informative_dynamic")
    return active.select("otu", fate.alias("fate"))


def no_adapter_policy(reads: DataFrame) -> DataFrame:
    """One row: whether reads (header) without and with an adapter were seen, and whether both were."""
    adapter = F.nullif(keyed_token("header", "adapter"), F.lit(""))
    base = F.regexp_replace(F.regexp_replace(adapter, r"_[0-9]+$", ""), r"^(.*?)_[0-9]+_(.*)$", "$1_$2")
    none = F.coalesce(F.bool_or(is_no_adapter(adapter)), F.lit(False))
    some = F.coalesce(F.bool_or(~is_no_adapter(adapter) & ~F.lower(base).isin("", "no_adapter")), F.lit(False))
    return reads.agg(none.alias("observed_no_adapter"), some.alias("observed_adapter")).withColumn("separate", F.expr("observed_no_adapter and observed_adapter"))


def admitted(rows: DataFrame, pairs: DataFrame, allow_unassigned: bool) -> DataFrame:
    """rows (otu, marker, kingdom, adapter) of a configured (marker, kingdom), or Unassigned ones of a configured marker if allowed, with how they came in."""
    known = pairs.select("marker", F.lower("kingdom").alias("_k"), F.lit(True).alias("compatible")).distinct()
    markers = pairs.select("marker", F.lit(True).alias("configured")).distinct()
    held = rows.withColumn("_k", F.lower("kingdom")).join(known, ["marker", "_k"], "left").join(markers, "marker", "left")
    loose = F.lit(allow_unassigned) & F.coalesce("configured", F.lit(False)) & (F.col("kingdom") == "Unassigned") & ~is_no_adapter(F.coalesce("adapter", F.lit("")))
    way = F.when(F.col("compatible"), "compatible").when(loose, "unassigned")
    return held.withColumn("admission", way).where("admission is not null").drop("_k", "compatible", "configured")


def admitted_unassigned_otus(admissions: DataFrame) -> DataFrame:
    """OTUs admitted by unassigned rows alone."""
    return admissions.groupBy("otu").agg(F.max((F.col("admission") == "compatible").cast("int")).alias("c")).where("c = 0").select("otu")


def resolve_ids(requested: DataFrame, headers: DataFrame) -> DataFrame:
    """id and the header it stands for: itself, else the best header of the longest key that any header shares.

    Keys: (uuid, target, barcode, adapter), (uuid, target, adapter), (uuid, target), (uuid); best: model, then the least header.
    """

    def keyed(df: DataFrame, column: str) -> DataFrame:
        part = lambda k: F.coalesce(F.get(F.split(column, r"\|"), F.lit(k)), F.lit(""))
        tag = lambda k: F.coalesce(keyed_token(column, k), F.lit(""))
        u, t, b, a = part(0), part(1), tag("barcode"), tag("adapter")
        keys = [F.concat_ws("\x01", u, t, b, a), F.concat_ws("\x01", u, t, a), F.concat_ws("\x01", u, t), u]
        return df.select(column, F.posexplode(F.array(F.col(column), *keys)).alias("level", "key"))

    ids = requested.select(F.regexp_replace(F.regexp_replace("id", r"\s.*$", ""), r"\|OTUB_[^|\s]+$", "").alias("id")).where("id <> ''").distinct()
    rank = F.when(F.col("level") == 0, 0).otherwise(-F.when(header_model("header") == "sup", 3).when(header_model("header") == "hac", 2).otherwise(1))
    best = keyed(headers.distinct(), "header").groupBy("level", "key").agg(F.min(F.struct(rank.alias("rank"), "header")).alias("best"))
    met = keyed(ids, "id").join(best, ["level", "key"])
    return met.groupBy("id").agg(F.min(F.struct("level", "best.header")).alias("m")).select("id", "m.header")


def assigned_otu_keys(provenance: DataFrame, assigned: DataFrame) -> DataFrame:
    """otu_key of assigned consensuses; provenance that names another display key is fatal, a stable key NA is left out."""
    met = provenance.where("consensus_id <> '' and otu_key <> '' and upper(otu_key) <> 'NA'").join(assigned, "consensus_id")
    require_none(met.where("display_otu_key <> otu_key"), "provenance and display differ")
    return met.where("stable_otu_key <> 'NA'").select("otu_key").distinct()


def best_consensus(entries: DataFrame, keys: list[str], target: str | None = None) -> DataFrame:
    """Per key the entry (header, reads, ordinal) with most reads, of equals the first; the target's header wins if it is there."""
    wanted = F.lit(0) if target is None else (F.col("header") == target).cast("int")
    order = W.partitionBy(*keys).orderBy(F.desc(wanted), F.desc("reads"), "ordinal")
    total = F.sum("reads").over(W.partitionBy(*keys))
    return entries.withColumn("total_reads", total).withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def candidate_tiers(hits: DataFrame, pident: float, coverage: float) -> DataFrame:
    """hits with discovery_tier ('priority' from both limits on, else 'review') and their place in review order."""
    tier = F.when((F.col("pident") >= pident) & (F.col("coverage") >= coverage), "priority").otherwise("review")
    order = W.partitionBy("query").orderBy(F.when(F.col("discovery_tier") == "priority", 0).otherwise(1), F.desc("bitscore"), "reference")
    return hits.withColumn("discovery_tier", tier).withColumn("place", F.row_number().over(order))


def adjudications(references: DataFrame, edges: DataFrame) -> DataFrame:
    """references (reference, family) with their best neighbour of another family over edges (a, b, pident, coverage), and the disposition."""
    both = edges.select(F.col("a").alias("reference"), F.col("b").alias("neighbour"), "pident", "coverage")
    both = both.union(edges.select("b", "a", "pident", "coverage"))
    family = references.select(F.col("reference").alias("neighbour"), F.col("family").alias("other"))
    cross = both.join(references, "reference").join(family, "neighbour").where("family <> '' and other <> '' and family <> other")
    best = cross.groupBy("reference").agg(F.min(F.struct((-F.col("pident")).alias("p"), (-F.col("coverage")).alias("c"), "neighbour")).alias("best"))
    disposition = F.when(F.col("best").isNotNull(), "cross_family_sequence_label_conflict_candidate").otherwise("unresolved_insufficient_local_discriminator")
    return references.join(best, "reference", "left").select("reference", "family", F.col("best.neighbour").alias("neighbour"), disposition.alias("disposition"))


def with_baseline(rows: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """rows, and those of the baseline whose keys they lack."""
    return rows.unionByName(baseline.join(rows.select(*keys).distinct(), keys, "left_anti"))


def consolidate_unassigned(state: DataFrame, fresh: DataFrame) -> DataFrame:
    """The state of pruned unassigned reads with this round's."""
    return state.unionByName(fresh).distinct()
