"""Queries built from tidewater.operators and tidewater.functions over the adapter views, each with SQL written apart from them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.functions import labels as B
from tidewater.functions import lineages as L
from tidewater.functions import scalars as S
from tidewater.operators import orders as O
from tidewater.operators import resolution as R
from tidewater.operators import states as T
from tidewater.operators import strict as X
from tidewater.sources import metadata as M
from tidewater.sources import tables as Q
from tidewater.plans.adapters import view

GENUS_FROM, SPECIES_FROM = 93, 95


def _candidates(spark, sf_dir):
    """Best alignments as candidates: every subject is a configured taxid with its lineage, a rank memory and, but for some, a title."""
    held = view(spark, sf_dir, "best").join(view(spark, sf_dir, "lineage"), "subject")
    na, own = F.lit("NA"), F.array("kingdom", F.lit("NA"), F.lit("NA"), F.lit("NA"), "family", "genus", "species")
    tag = lambda prefix, x: F.when(F.col(x) == "NA", "NA").otherwise(F.concat(F.lit(prefix), F.col(x)))
    species = F.when(F.col("species") == "NA", "NA").otherwise((-F.col("subject")).cast("string"))
    return held.select(
        "hash",
        (-F.col("subject")).alias("taxid"),
        "pident",
        F.lit("Metazoa").alias("kingdom"),
        own.alias("authority"),
        F.lit(None).cast("array<string>").alias("numeric"),
        F.when(F.col("subject") % 17 != 0, F.array(own)).alias("titles"),
        (F.col("subject") % 19 == 0).alias("wrong_marker"),
        F.lit(False).alias("bad_title"),
        F.array(species, tag("-g ", "genus"), tag("-f ", "family"), na).alias("memory"),
        F.lit(None).cast("map<string, array<string>>").alias("ancestors"),
    )


def _told(df, *keys):
    return df.select(*keys, "status", "reason", "resolved_taxid", F.col("depth").cast("long").alias("depth"), L.lineage_text("ranks").alias("lineage"))


def _resolved(spark, sf_dir):
    return R.resolve_candidates(_candidates(spark, sf_dir), GENUS_FROM, SPECIES_FROM)


def _groups(spark, sf_dir):
    return R.resolve_groups(_resolved(spark, sf_dir), ["hash"])


def j03_resolve_candidate(spark, sf_dir):
    return _told(_resolved(spark, sf_dir), "hash", "taxid")


def j06_group_resolve(spark, sf_dir):
    return _told(_groups(spark, sf_dir), "hash")


def _members(spark, sf_dir):
    return view(spark, sf_dir, "members").join(_groups(spark, sf_dir), F.col("read_id") == F.col("hash"), "left").drop("hash").withColumn("status", F.coalesce("status", F.lit("NO_HIT")))


def j07_vote_of_members(spark, sf_dir):
    done = R.vote(_members(spark, sf_dir), ["otu", "marker"])
    return done.select("otu", "marker", "status", "resolved_taxid", F.col("depth").cast("long").alias("depth"), L.lineage_text("ranks").alias("lineage"), "votes", "support", "winner_count", "member_count")


def j09_marker_contract(spark, sf_dir):
    evidence = _groups(spark, sf_dir).withColumnRenamed("hash", "read_id")
    done = R.contract(view(spark, sf_dir, "members"), evidence, "read_id", ["otu", "marker"])
    return done.select("otu", "marker", "read_id", "status", F.col("depth").cast("long").alias("depth"), "cluster_status", "cluster_votes", "cluster_member_count")


def j10_consensus_cap(spark, sf_dir):
    whole = R.resolve_candidates(_candidates(spark, sf_dir), 0, 0)
    return _told(R.cap_by_identity(whole, 91, GENUS_FROM, SPECIES_FROM), "hash", "taxid")


def _placed(df, keys, order):
    return df.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))


def a03_skip_done(spark, sf_dir):
    path = F.concat(F.when(F.col("doc_id") % 2 == 0, "/in/").otherwise("/done/"), F.col("doc_id"), F.lit(".pod5"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(path.alias("path"), F.col("n_chars").cast("long").alias("size"))
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    ledger = toxic.select(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/in/"), "doc_id", F.lit(".pod5\t1\t2"))).otherwise(F.concat("doc_id", F.lit(".pod5"))).alias("value"))
    return Q.skip_done(docs.union(docs), ledger, "/done")


def h03_round_order(spark, sf_dir):
    label = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("Round"), F.col("event_id") % 12, F.lit("_b"), F.col("event_id") % 7)).otherwise("")
    stamp = F.when(F.col("event_id") % 6 == 0, "soon").otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00Z")))
    rounds = view(spark, sf_dir, "rounds").select("otu", "event_id", label.alias("label"), stamp.alias("stamp"), "marker")
    return _placed(rounds, ["otu"], [*O.round_order(F.col("label"), F.col("stamp"), F.col("marker")), "event_id"]).select("otu", "event_id", "place")


def h04_run_order(spark, sf_dir):
    day = lambda n: F.concat(F.lit("2024-02-"), F.lpad((F.col("o_orderkey") % n + 1).cast("string"), 2, "0"))
    updated = F.when(F.col("o_orderkey") % 4 == 0, "").when(F.col("o_orderkey") % 4 == 1, "never").otherwise(F.concat(day(28), F.lit("T01:00:00+02:00")))
    runs = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", F.col("o_orderkey").cast("string").alias("run_id"), updated.alias("updated"), day(20).alias("last_round"))
    return _placed(runs, ["o_custkey"], O.run_order(F.col("updated"), F.col("last_round"), F.col("run_id"))).select("o_custkey", "run_id", "place")


def h05_reported_order(spark, sf_dir):
    shown = F.when(F.col("l_linenumber") == 7, "X_1").otherwise(F.concat(F.lit("OTUB_"), "l_suppkey"))
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_returnflag").alias("marker"), shown.alias("shown"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("member")).distinct()
    return O.numbered(rows, O.reported_order(F.col("marker"), F.col("shown"), F.col("member")))


def k04_merge_renumber(spark, sf_dir):
    groups = view(spark, sf_dir, "members").select("otu", F.when(F.col("otu") % 2 == 0, "A").otherwise("F").alias("origin")).distinct()
    return O.numbered(groups, [F.col("origin").asc(), F.col("otu").asc()]).select("otu", "origin", (F.col("place") - 1).alias("cluster"))


def l13_feeder_slices(spark, sf_dir):
    placed = O.numbered(view(spark, sf_dir, "rounds").select("event_id"), [F.col("event_id").asc()])
    return placed.select("event_id", F.floor((F.col("place") - 1) / 500).alias("slice"))


def a16_run_rows(spark, sf_dir):
    k = F.col("doc_id")
    name = F.when(k % 7 == 0, "a b").when(k % 7 == 1, F.concat(F.lit("No_adapter_"), k % 3)).otherwise(F.concat(F.lit("s"), k))
    code = F.when(k % 4 == 0, "p/|1").otherwise("p1")
    copy = F.when(k % 5 == 0, None).when(k % 5 == 1, "r_1").otherwise("r1")
    well, plate = F.concat(F.lit("A"), k % 12), F.concat(F.lit("P"), k % 4)
    demult = F.when(k % 6 == 0, ">x").otherwise(F.concat(F.lit(">"), well, F.lit("_"), plate))
    cells = zip((name, code, copy, well, plate, F.col("source"), demult), M.MANDATORY)
    sheet = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *[x.alias(y) for x, y in cells])
    runs = [r[0] for r in sheet.agg(F.min("Run")).collect()]
    return M.select_run(sheet, runs[0], strict=False).select("doc_id", "unit", "problems")


def k11_adapter_route(spark, sf_dir):
    return view(spark, sf_dir, "headers").select("doc_id", S.adapter_class(F.concat("header", F.lit(" runid=1|adapter=x"))).alias("route"))


def n11_read_counts(spark, sf_dir):
    half = F.col("doc_id") % 2 == 0
    summary = view(spark, sf_dir, "reads").groupBy(F.col("sample").alias("sample_name"), F.when(half, F.concat("sample", F.lit("-t"))).alias("track_sample_label"), (F.col("doc_id") % 3).alias("track_replicate_suffix"), F.lit("x").alias("replicate"), F.col("marker").alias("barcode"), F.col("model").alias("basecalling_model")).agg(F.count("*").alias("read_count"))
    return O.read_counts(summary)


def c_lineages(spark, sf_dir):
    rows = view(spark, sf_dir, "lineage").withColumn("text", F.concat_ws(";", F.concat(F.lit("k__"), F.col("kingdom")), F.concat(F.lit("F__"), F.col("family")), F.concat(F.lit("g__"), F.col("genus")), F.concat(F.lit("s__"), F.col("species"))))
    rows = rows.withColumn("ranks", L.canonical_lineage("text")).withColumn("cut", L.cut_to("ranks", F.lit(4)))
    return rows.select("subject", L.lineage_text("ranks").alias("lineage"), L.lineage_depth("ranks").cast("long").alias("depth"), L.is_assigned_lineage("text").alias("assigned"), L.lineage_rank("text", "g__").alias("genus"), F.size(L.conflicts("ranks", "cut")).cast("long").alias("conflicts"), F.size(L.one_sided("ranks", "cut")).cast("long").alias("one_sided"))


def c_labels(spark, sf_dir):
    rows = view(spark, sf_dir, "headers").select("doc_id", F.concat(F.col("doc_id") % 7, F.lit("_x_"), F.col("doc_id") % 3, F.lit("_COI_"), F.col("doc_id") % 2).alias("label"), F.concat(F.lit("s|reads-"), F.col("doc_id")).alias("h"))
    platform, method, subsample, replicate = B.sample_dimensions("label")
    sample, number, unit, marker = B.track_unit("label")
    return rows.select("doc_id", B.sample_base("label").alias("base"), B.marker_of_label("label").alias("marker"), B.stable_sample_id("label").alias("stable_id"), platform, method, subsample, replicate, sample, unit, B.reads_of("h").alias("reads"), B.marker_of_token(F.regexp_replace("label", "_", "-")).alias("token_marker"), B.threshold_of(F.lit("COI"), {"COI": 90}).alias("threshold"), B.fixed_number(F.col("doc_id") / 7, "percent").alias("percent"), F.substring_index(B.subject_label("h"), "|", 1).alias("subject"))


def _otus(spark, sf_dir):
    members = view(spark, sf_dir, "members").select("otu", F.col("read_id").cast("string").alias("uuid"), F.col("read_id").alias("ordinal"))
    return members.join(spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("otu"), F.when(F.col("s_nationkey") != 3, F.concat(F.lit("K"), F.col("s_suppkey"))).alias("key")), "otu")


def _streak_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").where("s_nationkey > 10").select(F.concat(F.lit("K"), F.col("s_suppkey")).alias("key"), F.col("s_nationkey").cast("long").alias("streak"))


def l07_unassigned_streak(spark, sf_dir):
    assigned = spark.read.parquet(f"{sf_dir}/supplier.parquet").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("otu"))
    after, _ = T.unassigned_streak(_otus(spark, sf_dir), assigned, _streak_of(spark, sf_dir), 2, 100_000, 15)
    return after.select("key", F.col("streak").cast("long").alias("streak"), "due")


def l07_unassigned_prune(spark, sf_dir):
    assigned = spark.read.parquet(f"{sf_dir}/supplier.parquet").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("otu"))
    return T.unassigned_streak(_otus(spark, sf_dir), assigned, _streak_of(spark, sf_dir), 2, 100_000, 15)[1]


def _clusters(spark, sf_dir):
    grouped = view(spark, sf_dir, "reads").groupBy(F.col("sample").alias("otu"), F.concat_ws("/", "marker", "model").alias("hash"))
    return grouped.agg(F.max("qscore").cast("double").alias("qscore"), F.count("*").alias("n"), F.min("doc_id").alias("ordinal"))


def l09_lock_rules(spark, sf_dir):
    clusters, out = _clusters(spark, sf_dir), None
    for mode, more in (("ratio", {"ratio": 0.5}), ("share", {"pool_share": 0.05, "top_share": 0.5}), ("gap", {"gap_ratio": 1.05, "gap_reads": 1})):
        one = T.lock_rule(clusters, mode, 15, 3, **more).select(F.lit(mode).alias("mode"), "otu", "passes", F.col("significant").cast("long").alias("significant"))
        out = one if out is None else out.union(one)
    return out


def n03_otu_fate(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    active = part.select(F.col("p_partkey").alias("otu"), (F.col("p_size") > 20).alias("seen"), (F.col("p_retailprice") > 950).alias("assigned"), (F.col("p_size") < 5).alias("size_due"))
    return T.fate_of_otus(active, False, True, False)


def g17_best_consensus(spark, sf_dir):
    reads = view(spark, sf_dir, "reads").select("sample", F.col("read_id").alias("header"), F.col("len").alias("reads"), F.col("doc_id").alias("ordinal"))
    return T.best_consensus(reads, ["sample"]).select("sample", "header", "reads", "total_reads")


def k09_candidate_tiers(spark, sf_dir):
    hits = view(spark, sf_dir, "hsps").select(F.col("hash").alias("query"), F.concat_ws("-", "subject", "ordinal").alias("reference"), "pident", F.col("qend").alias("coverage"), "bitscore")
    return T.candidate_tiers(hits, 95, 40).select("query", "reference", "discovery_tier", F.col("place").cast("long").alias("place"))


def k08_adjudication(spark, sf_dir):
    references = view(spark, sf_dir, "lineage").select(F.col("subject").alias("reference"), "family")
    edges = view(spark, sf_dir, "hsps").select(F.col("subject").alias("a"), (F.col("hash") % 200 + 1).alias("b"), "pident", F.col("qend").alias("coverage")).where("a <> b and pident >= 95")
    return T.adjudications(references, edges)


def d20_admission(spark, sf_dir):
    rows = view(spark, sf_dir, "lineage").select(F.col("subject").alias("otu"), F.col("family").alias("marker"), F.when(F.col("genus") == "NA", "Unassigned").otherwise(F.col("genus")).alias("kingdom"), F.lit("ad_1").alias("adapter"))
    pairs = view(spark, sf_dir, "lineage").where("genus like '%1'").select(F.col("family").alias("marker"), F.upper("genus").alias("kingdom"))
    return T.admitted(rows, pairs, True).select("otu", "marker", "kingdom", "admission")


def e25_resolve_ids(spark, sf_dir):
    heads = view(spark, sf_dir, "headers").select("header")
    asked = view(spark, sf_dir, "headers").select(F.concat(F.regexp_replace("header", r"\|barcode=.*", "|barcode=other"), F.lit("|OTUB_7-X")).alias("id"))
    return T.resolve_ids(asked, heads)


def e11_round_join(spark, sf_dir):
    counts = view(spark, sf_dir, "sized").groupBy("otu", "round").agg(F.sum("n").alias("n"))
    amounts = view(spark, sf_dir, "rounds").groupBy("otu", "round").agg(F.sum("amount").alias("amount"))
    return X.strict_join(counts, amounts, ["otu", "round"])


def e22_dispositions(spark, sf_dir):
    references = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("reference"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_returnflag = 'R' and l_quantity > 49").select(F.col("l_partkey").alias("reference")).distinct()
    return X.dispositions(references, lines.withColumn("action", F.lit("quarantine")))


def o07_conservation(spark, sf_dir):
    lines = view(spark, sf_dir, "members").groupBy("otu").agg(F.count("*").alias("total"), *[F.count(F.when(F.col("marker") == x, 1)).alias(x.lower()) for x in "AR"])
    return X.conservation(lines, "total", ["a", "r"]).select("otu", "total")


def o08_aggregate_invariants(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    summary = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") % 12).alias("n"))
    return X.aggregate_mismatches(orders, summary, ["o_custkey"], "n").select("o_custkey", "found")


def o10_partition(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"), "p_size")
    return X.not_a_partition(part, [part.where("p_size < 20"), part.where("p_size > 18"), part.where("p_size = 50")], "k").select("k", F.col("parts").cast("long").alias("parts"))


def l21_unassigned_status(spark, sf_dir):
    rounds = view(spark, sf_dir, "rounds").select("round", F.when(F.col("marker") == "error", "off").when(F.col("marker") == "click", "observe").otherwise("apply").alias("mode")).distinct()
    return rounds.select("round", "mode", T.unassigned_prune_status(F.col("mode"), F.col("round"), 5).alias("status"))


_C = """(SELECT b.hash, -b.subject AS taxid, b.pident, l.family AS f, l.genus AS g, l.species AS s,
 CASE WHEN b.subject % 19 = 0 THEN 'wrong_kingdom_or_marker' WHEN b.subject % 17 = 0 THEN 'missing_deployed_validation' END AS bad FROM best b JOIN lineage l ON b.subject = l.subject)"""


def _tiered(genus: str, species: str) -> str:
    return f"""(SELECT *, CASE WHEN pident >= {species} AND s <> 'NA' THEN 6 WHEN pident >= {genus} AND g <> 'NA' THEN 5 ELSE 4 END AS depth FROM {_C})"""


def _cut(depth: str) -> str:
    """The columns f, g and s of a candidate at a depth, and their text."""
    return f"CASE WHEN {depth} >= 5 THEN g ELSE 'NA' END AS g, CASE WHEN {depth} >= 6 THEN s ELSE 'NA' END AS s"


_TEXT = "'K__Metazoa;p__NA;c__NA;o__NA;f__' || f || ';g__' || g || ';s__' || s"
_TAXID = "CASE depth WHEN 6 THEN taxid::varchar WHEN 5 THEN '-g ' || g ELSE '-f ' || f END"
_R = f"""(SELECT hash, taxid, CASE WHEN bad IS NULL THEN 'ASSIGNED' WHEN bad LIKE 'wrong%' THEN 'REFERENCE_INCONSISTENT' ELSE 'REFERENCE_UNRESOLVED' END AS status,
 CASE WHEN bad IS NULL THEN 'NA' ELSE taxid || ':' || bad END AS reason, CASE WHEN bad IS NULL THEN {_TAXID} ELSE 'NA' END AS resolved_taxid,
 CASE WHEN bad IS NULL THEN depth ELSE -1 END AS depth, f, {_cut('depth')}, g AS whole_g FROM {_tiered('93', '95')})"""
_G1 = f"""(SELECT hash, count(*) AS n, string_agg(DISTINCT CASE WHEN status = 'REFERENCE_INCONSISTENT' THEN reason END, ',' ORDER BY CASE WHEN status = 'REFERENCE_INCONSISTENT' THEN reason END) AS worse,
 string_agg(DISTINCT CASE WHEN status = 'REFERENCE_UNRESOLVED' THEN reason END, ',' ORDER BY CASE WHEN status = 'REFERENCE_UNRESOLVED' THEN reason END) AS bad,
 count(DISTINCT concat_ws('/', resolved_taxid, f, g, s)) AS kinds, any_value(resolved_taxid) AS taxid, any_value(depth) AS own_depth, any_value(f) AS own_f, any_value(g) AS own_g, any_value(s) AS own_s,
 count(DISTINCT f) AS nf, count(DISTINCT nullif(g, 'NA')) AS ng, count(nullif(g, 'NA')) AS kg, max(nullif(g, 'NA')) AS one_g, count(DISTINCT nullif(s, 'NA')) AS ns, count(nullif(s, 'NA')) AS ks, max(nullif(s, 'NA')) AS one_s,
 max(f) AS one_f, list({{'t': taxid, 'g': whole_g}}) AS sources FROM {_R} GROUP BY hash)"""
_G2 = f"""(SELECT *, CASE WHEN nf > 1 THEN 'NA' ELSE one_f END AS lf, CASE WHEN nf = 1 AND ng = 1 AND kg = n THEN one_g ELSE 'NA' END AS lg, CASE WHEN nf = 1 AND ng <= 1 AND ns = 1 AND ks = n THEN one_s ELSE 'NA' END AS ls FROM {_G1})"""
_G3 = f"""(SELECT *, CASE WHEN ls <> 'NA' THEN 6 WHEN lg <> 'NA' THEN 5 WHEN lf <> 'NA' THEN 4 ELSE 0 END AS ld, list_distinct(list_transform(list_filter(sources, lambda x: x.g = lg), lambda x: x.t)) AS fit FROM {_G2})"""
_G = f"""(SELECT hash, CASE WHEN worse IS NOT NULL THEN 'REFERENCE_INCONSISTENT' WHEN bad IS NOT NULL THEN 'REFERENCE_UNRESOLVED' WHEN kinds = 1 THEN 'ASSIGNED' ELSE 'AMBIGUOUS_TIE' END AS status,
 CASE WHEN worse IS NOT NULL THEN worse WHEN bad IS NOT NULL THEN bad WHEN kinds = 1 THEN 'NA' ELSE 'lineage_lca' END AS reason,
 CASE WHEN worse IS NOT NULL OR bad IS NOT NULL THEN 'NA' WHEN kinds = 1 THEN taxid WHEN ld = 0 THEN 'NA' WHEN ld = 4 THEN '-f ' || lf WHEN ld = 5 THEN '-g ' || lg WHEN len(fit) = 1 THEN fit[1]::varchar ELSE 'NA' END AS resolved_taxid,
 CASE WHEN worse IS NOT NULL OR bad IS NOT NULL THEN -1 WHEN kinds = 1 THEN own_depth ELSE ld END AS depth,
 CASE WHEN kinds = 1 THEN own_f ELSE lf END AS f, CASE WHEN kinds = 1 THEN own_g ELSE lg END AS g, CASE WHEN kinds = 1 THEN own_s ELSE ls END AS s FROM {_G3})"""
#: The lineage's text, empty where there is no lineage.
_LINE = f"CASE WHEN depth < 0 THEN '' ELSE {_TEXT} END"
_M = f"(SELECT m.otu, m.marker, m.read_id, coalesce(status, 'NO_HIT') AS status, coalesce(depth, -1) AS depth, resolved_taxid, f, g, s FROM members m LEFT JOIN {_G} r ON m.read_id = r.hash)"
_V1 = f"""(SELECT otu, marker, resolved_taxid, f, g, s, count(*) AS support, max(CASE WHEN status = 'AMBIGUOUS_TIE' THEN 1 ELSE 0 END) AS tied, sum(count(*)) OVER (PARTITION BY otu, marker) AS votes,
 rank() OVER (PARTITION BY otu, marker ORDER BY count(*) DESC) AS place FROM {_M} WHERE status IN ('ASSIGNED', 'AMBIGUOUS_TIE') GROUP BY otu, marker, resolved_taxid, f, g, s)"""
_V2 = f"""(SELECT otu, marker, any_value(votes) AS votes, max(support) AS support, count(*) AS w, max(tied) AS tied, any_value(resolved_taxid) AS taxid, list_distinct(list(f)) AS fs, list_distinct(list(g)) AS gs, list_distinct(list(s)) AS ss FROM {_V1} WHERE place = 1 GROUP BY otu, marker)"""
_V3 = f"""(SELECT *, len(list_filter(fs, lambda x: x <> 'NA')) <= 1 AS of, len(list_filter(gs, lambda x: x <> 'NA')) <= 1 AS og FROM {_V2})"""
_V4 = f"""(SELECT *, CASE WHEN len(fs) = 1 THEN fs[1] ELSE 'NA' END AS f, CASE WHEN of AND len(gs) = 1 THEN gs[1] ELSE 'NA' END AS g, CASE WHEN of AND og AND len(ss) = 1 THEN ss[1] ELSE 'NA' END AS s FROM {_V3})"""
_ALL = f"""(SELECT otu, marker, count(*) AS member_count, CASE WHEN bool_or(status = 'REFERENCE_INCONSISTENT') THEN 'REFERENCE_INCONSISTENT' WHEN bool_or(status = 'REFERENCE_UNRESOLVED') THEN 'REFERENCE_UNRESOLVED' ELSE 'NO_HIT' END AS worst FROM {_M} GROUP BY otu, marker)"""
_V = f"""(SELECT a.otu, a.marker, CASE WHEN w IS NULL THEN worst WHEN w = 1 AND tied = 0 THEN 'ASSIGNED' ELSE 'AMBIGUOUS_TIE' END AS status, CASE WHEN w = 1 THEN taxid ELSE 'NA' END AS resolved_taxid,
 CASE WHEN w IS NULL THEN -1 WHEN s <> 'NA' THEN 6 WHEN g <> 'NA' THEN 5 WHEN f <> 'NA' THEN 4 ELSE 0 END AS depth, f, g, s, coalesce(votes, 0) AS votes, coalesce(support, 0) AS support, coalesce(w, 0) AS winner_count, member_count
 FROM {_ALL} a LEFT JOIN {_V4} v ON a.otu = v.otu AND a.marker = v.marker)"""
_CAPPED = f"""(SELECT *, CASE WHEN bad IS NOT NULL THEN -1 WHEN pident >= 95 AND depth >= 6 THEN 6 WHEN pident >= 93 AND depth >= 5 AND g <> 'NA' THEN 5 WHEN pident >= 91 THEN 4 ELSE 0 END AS cd,
 CASE WHEN pident >= 95 THEN 6 WHEN pident >= 93 THEN 5 WHEN pident >= 91 THEN 4 ELSE 3 END AS cap FROM {_tiered('0', '0')})"""
_OTU = "(SELECT m.otu, count(DISTINCT m.read_id) AS size, max(CASE WHEN s_nationkey <> 3 THEN 'K' || s_suppkey END) AS key, max(s_acctbal) > 5000 AS assigned, max(CASE WHEN s_nationkey > 10 THEN s_nationkey ELSE 0 END) + 1 AS streak FROM members m JOIN supplier ON m.otu = s_suppkey GROUP BY m.otu)"
_K = "(SELECT sample AS otu, marker || '/' || model AS hash, max(qscore) AS q, count(*) AS n, min(doc_id) AS ordinal FROM reads GROUP BY ALL)"

BUILT = {
    "j03_resolve_candidate": (j03_resolve_candidate, f"SELECT hash, taxid, status, reason, resolved_taxid, depth::bigint AS depth, {_LINE} AS lineage FROM {_R}"),
    "j06_group_resolve": (j06_group_resolve, f"SELECT hash, status, reason, resolved_taxid, depth::bigint AS depth, {_LINE} AS lineage FROM {_G}"),
    "j07_vote_of_members": (j07_vote_of_members, f"SELECT otu, marker, status, resolved_taxid, depth::bigint AS depth, {_LINE} AS lineage, votes::bigint AS votes, support::bigint AS support, winner_count::bigint AS winner_count, member_count FROM {_V}"),
    "j09_marker_contract": (j09_marker_contract, f"SELECT m.otu, m.marker, m.read_id, m.status, m.depth::bigint AS depth, v.status AS cluster_status, v.votes::bigint AS cluster_votes, v.member_count AS cluster_member_count FROM {_M} m JOIN {_V} v ON m.otu = v.otu AND m.marker = v.marker"),
    "j10_consensus_cap": (j10_consensus_cap, f"""SELECT hash, taxid, CASE WHEN bad IS NULL THEN 'ASSIGNED' WHEN bad LIKE 'wrong%' THEN 'REFERENCE_INCONSISTENT' ELSE 'REFERENCE_UNRESOLVED' END AS status, CASE WHEN bad IS NULL THEN 'NA' ELSE taxid || ':' || bad END AS reason,
 CASE WHEN bad IS NOT NULL THEN 'NA' WHEN cd = cap THEN {_TAXID} WHEN cd = 0 THEN 'NA' WHEN cd = 5 THEN '-g ' || g ELSE '-f ' || f END AS resolved_taxid, cd::bigint AS depth,
 CASE WHEN bad IS NOT NULL THEN '' ELSE 'K__Metazoa;p__NA;c__NA;o__NA;f__' || CASE WHEN cap >= 4 THEN f ELSE 'NA' END || ';g__' || CASE WHEN cap >= 5 AND depth >= 5 THEN g ELSE 'NA' END || ';s__' || CASE WHEN cap >= 6 AND depth >= 6 THEN s ELSE 'NA' END END AS lineage FROM {_CAPPED}"""),
    "c_lineages": (c_lineages, "SELECT subject, 'K__' || kingdom || ';p__NA;c__NA;o__NA;f__' || family || ';g__' || genus || ';s__' || species AS lineage, (CASE WHEN species <> 'NA' THEN 6 WHEN genus <> 'NA' THEN 5 ELSE 4 END)::bigint AS depth, true AS assigned, genus, 0::bigint AS conflicts, ((genus <> 'NA')::int + (species <> 'NA')::int)::bigint AS one_sided FROM lineage"),
    "c_labels": (c_labels, """SELECT doc_id, a || '_x_' || b AS base, 'coi' AS marker, lower(label) || '_' || substr(sha1(label), 1, 8) AS stable_id, a AS platform, 'x' AS sampling_method, b AS subsample, 'COI' AS replicate, a || '_x' AS sample, 'COI' AS unit, doc_id AS reads, 'COI' AS token_marker, 90.0::double AS threshold, printf('%.3f', doc_id / 7.0::double) AS percent, 's' AS subject
 FROM (SELECT doc_id, (doc_id % 7)::varchar AS a, (doc_id % 3)::varchar AS b, concat(doc_id % 7, '_x_', doc_id % 3, '_COI_', doc_id % 2) AS label FROM documents)"""),
    "l07_unassigned_streak": (l07_unassigned_streak, f"SELECT key, streak::bigint AS streak, streak >= 15 AS due FROM {_OTU} WHERE size >= 2 AND key IS NOT NULL AND NOT assigned"),
    "l07_unassigned_prune": (l07_unassigned_prune, f"SELECT DISTINCT m.read_id::varchar AS uuid FROM members m JOIN {_OTU} o ON m.otu = o.otu WHERE size >= 2 AND key IS NOT NULL AND NOT assigned AND streak >= 15"),
    "l09_lock_rules": (l09_lock_rules, f"""SELECT 'ratio' AS mode, otu, coalesce(most <= round(0.5 * least, 6), false) AS passes, k AS significant FROM (SELECT otu, min(n) FILTER (q >= 15 AND n >= 3) AS least, coalesce(max(n) FILTER (NOT (coalesce(q, -1) >= 15 AND n >= 3)), 0) AS most, count(*) FILTER (q >= 15 AND n >= 3) AS k FROM {_K} GROUP BY otu)
 UNION ALL SELECT 'share', otu, k > 0, k FROM (SELECT otu, count(*) FILTER (q >= 15 AND n >= 3 AND round(n / pool, 6) >= 0.05 AND round(n / top, 6) >= 0.5) AS k FROM (SELECT *, sum(n) OVER (PARTITION BY otu) AS pool, max(CASE WHEN q >= 15 AND n >= 3 THEN n END) OVER (PARTITION BY otu) AS top FROM {_K}) GROUP BY otu)
 UNION ALL SELECT 'gap', o.otu, coalesce(n1 IS NOT NULL AND (n2 IS NULL OR (round(n1 / n2, 6) >= 1.05 AND n1 - n2 >= 1)), false), coalesce(n1 IS NOT NULL AND (n2 IS NULL OR (round(n1 / n2, 6) >= 1.05 AND n1 - n2 >= 1)), false)::bigint
 FROM (SELECT DISTINCT otu FROM {_K}) o LEFT JOIN (SELECT otu, n AS n1, n2 FROM (SELECT *, row_number() OVER (PARTITION BY otu ORDER BY n DESC, ordinal) AS nth, lead(n) OVER (PARTITION BY otu ORDER BY n DESC, ordinal) AS n2 FROM {_K} WHERE q >= 15) WHERE nth = 1 AND n >= 3) t ON o.otu = t.otu"""),
    "n03_otu_fate": (n03_otu_fate, "SELECT p_partkey AS otu, CASE WHEN p_size > 20 THEN CASE WHEN p_retailprice > 950 THEN 'informative_dynamic' ELSE 'blast_unassigned' END WHEN p_size < 5 THEN 'size_streak' ELSE 'informative_dynamic' END AS fate FROM part"),
    "g17_best_consensus": (g17_best_consensus, "SELECT sample, arg_max(read_id, len * 10000000 - doc_id) AS header, max(len) AS reads, sum(len)::bigint AS total_reads FROM reads GROUP BY sample"),
    "k09_candidate_tiers": (k09_candidate_tiers, "SELECT hash AS query, subject || '-' || ordinal AS reference, CASE WHEN pident >= 95 AND qend >= 40 THEN 'priority' ELSE 'review' END AS discovery_tier, row_number() OVER (PARTITION BY hash ORDER BY pident >= 95 AND qend >= 40 DESC, bitscore DESC, subject || '-' || ordinal) AS place FROM hsps"),
    "k08_adjudication": (k08_adjudication, """SELECT subject AS reference, family, neighbour, CASE WHEN neighbour IS NULL THEN 'unresolved_insufficient_local_discriminator' ELSE 'cross_family_sequence_label_conflict_candidate' END AS disposition FROM lineage LEFT JOIN
 (SELECT e.a, e.b AS neighbour, row_number() OVER (PARTITION BY e.a ORDER BY e.pident DESC, e.qend DESC, e.b) AS nth FROM (SELECT subject AS a, hash % 200 + 1 AS b, pident, qend FROM hsps WHERE pident >= 95 UNION ALL SELECT hash % 200 + 1, subject, pident, qend FROM hsps WHERE pident >= 95) e
 JOIN lineage x ON e.a = x.subject JOIN lineage y ON e.b = y.subject WHERE e.a <> e.b AND x.family <> y.family) n ON n.a = subject AND nth = 1"""),
    "d20_admission": (d20_admission, """SELECT subject AS otu, family AS marker, CASE WHEN genus = 'NA' THEN 'Unassigned' ELSE genus END AS kingdom, CASE WHEN genus LIKE '%1' THEN 'compatible' ELSE 'unassigned' END AS admission FROM lineage l
 WHERE EXISTS (SELECT 1 FROM lineage p WHERE p.genus LIKE '%1' AND p.family = l.family AND (p.genus = l.genus OR l.genus = 'NA'))"""),
    "e25_resolve_ids": (e25_resolve_ids, "SELECT split_part(header, '|barcode=', 1) || '|barcode=other' AS id, header FROM headers"),
    "e11_round_join": (e11_round_join, "SELECT otu, round, count(*) AS n, sum(amount)::bigint AS amount FROM rounds GROUP BY otu, round"),
    "e22_dispositions": (e22_dispositions, "SELECT p_partkey AS reference, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 49) THEN 'quarantine' ELSE 'retain' END AS action FROM part"),
    "o07_conservation": (o07_conservation, "SELECT otu, count(*) AS total FROM members GROUP BY otu HAVING count(*) <> count(*) FILTER (marker IN ('A', 'R'))"),
    "o08_aggregate_invariants": (o08_aggregate_invariants, "SELECT c_custkey AS o_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS found FROM customer WHERE (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) <> c_custkey % 12"),
    "o10_partition": (o10_partition, "SELECT p_partkey AS k, ((p_size < 20)::int + (p_size > 18)::int + (p_size = 50)::int)::bigint AS parts FROM part WHERE p_size IN (19, 50)"),
    "l21_unassigned_status": (l21_unassigned_status, "SELECT DISTINCT round, mode, CASE WHEN mode = 'off' THEN 'mode_off' WHEN round < 6 THEN 'grace' WHEN mode = 'observe' THEN 'observe' ELSE 'applied' END AS status FROM (SELECT round, CASE marker WHEN 'error' THEN 'off' WHEN 'click' THEN 'observe' ELSE 'apply' END AS mode FROM rounds)"),
    "a03_skip_done": (a03_skip_done, """SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN '/in/' ELSE '/done/' END || doc_id || '.pod5' AS path, n_chars::bigint AS size FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.toxic = 1 AND l.doc_id = d.doc_id)"""),
    "h03_round_order": (h03_round_order, """SELECT otu, event_id, row_number() OVER (PARTITION BY otu ORDER BY event_id % 3 = 0, CASE WHEN event_id % 3 <> 0 THEN event_id % 12 END, CASE WHEN event_id % 3 <> 0 THEN event_id % 7 END,
 CASE WHEN event_id % 6 = 0 THEN 99 WHEN event_id % 3 = 0 THEN event_id % 28 END, marker, event_id) AS place FROM rounds"""),
    "h04_run_order": (h04_run_order, """SELECT o_custkey, o_orderkey::varchar AS run_id, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderkey % 4 WHEN 1 THEN NULL WHEN 0 THEN 24 * (o_orderkey % 20) ELSE 24 * (o_orderkey % 28) - 1 END DESC NULLS LAST, o_orderkey::varchar) AS place FROM orders"""),
    "h05_reported_order": (h05_reported_order, """SELECT *, row_number() OVER (ORDER BY marker, CASE WHEN shown = 'X_1' THEN 0 ELSE substr(shown, 6)::bigint END, member) AS place
 FROM (SELECT DISTINCT l_returnflag AS marker, CASE WHEN l_linenumber = 7 THEN 'X_1' ELSE 'OTUB_' || l_suppkey END AS shown, l_orderkey || '-' || l_linenumber AS member FROM lineitem)"""),
    "k11_adapter_route": (k11_adapter_route, "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'no_adapter' ELSE 'with_adapter' END AS route FROM documents"),
    "n11_read_counts": (n11_read_counts, "SELECT CASE WHEN doc_id % 2 = 0 THEN sample || '-t' ELSE '' END AS sample, (doc_id % 3)::varchar AS replicate, marker AS barcode, count(*) AS reads FROM reads WHERE model = 'hac' GROUP BY 1, 2, 3"),
    "k04_merge_renumber": (k04_merge_renumber, "SELECT otu, origin, CAST(dense_rank() OVER (ORDER BY origin, otu) - 1 AS BIGINT) AS cluster FROM (SELECT DISTINCT otu, CASE WHEN otu % 2 = 0 THEN 'A' ELSE 'F' END AS origin FROM members) AS x"),
    "l13_feeder_slices": (l13_feeder_slices, "SELECT event_id, CAST(floor((before) / 500) AS BIGINT) AS slice FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS before FROM rounds) AS x"),
    "a16_run_rows": (a16_run_rows, """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN 'r_1' ELSE 'r1' END || '_A' || doc_id % 12 || '_P' || doc_id % 4 AS unit, concat_ws('; ',
 CASE WHEN doc_id % 5 = 0 THEN 'Replicate is empty' END, CASE WHEN doc_id % 5 = 1 THEN 'Replicate must not contain whitespace or _' END, CASE WHEN doc_id % 7 = 0 THEN 'Sample_ID must not contain whitespace' END,
 CASE WHEN doc_id % 7 = 1 THEN 'Sample_ID must not use reserved no_adapter identity' END, CASE WHEN doc_id % 4 = 0 THEN 'Pipeline_ID must not contain |; Pipeline_ID must not contain /' END,
 CASE WHEN doc_id % 6 = 0 THEN 'demult_id must equal >A' || doc_id % 12 || '_P' || doc_id % 4 END) AS problems FROM documents WHERE source = (SELECT min(source) FROM documents)"""),
}
