"""Registered queries over the driver's tables and their DuckDB SQL.

``PLANS`` are declarative plans in SQL that both engines read. ``BUILT`` are DataFrame
compositions of tidewater.operators and tidewater.functions, each with SQL of its own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import ranking, rounds, taxonomy
from tidewater.operators.graph import connected_components
from tidewater.plans import adapters, built, evidence

PLANS = {
    # filters
    "d01_global_length": "SELECT read_id, len FROM reads WHERE len BETWEEN 286 AND 5000",
    "d02_marker_length": "SELECT r.read_id, r.marker, r.len FROM reads r JOIN (SELECT 'en' AS marker, 350 AS low, 2000 AS high UNION ALL SELECT 'de', 286, 1500) c ON r.marker = c.marker WHERE r.len BETWEEN c.low AND c.high",
    "d03_on_target_router": "SELECT hash, subject, family FROM (SELECT h.hash, h.subject, l.family, row_number() OVER (PARTITION BY h.hash ORDER BY h.ordinal, h.subject) AS nth FROM hsps h JOIN lineage l ON h.subject = l.subject) AS x WHERE nth = 1 AND family LIKE 'ECONOMY%'",
    "d04_split_child_exclusion": "SELECT m.otu, m.read_id FROM members m WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = m.read_id AND o.o_orderstatus = 'P')",
    "d05_qc_target_class": "SELECT o.o_orderkey AS read_id, CASE WHEN o.o_totalprice >= 100000 THEN 'IN' ELSE 'OUT' END AS qc_filter, CASE WHEN m.read_id IS NULL THEN 'OFF_TARGET' ELSE 'ON_TARGET' END AS target FROM orders o LEFT JOIN (SELECT DISTINCT read_id FROM members WHERE marker = 'R') m ON o.o_orderkey = m.read_id",
    "d06_hsp_validity": "SELECT hash, subject, CAST(floor((abs(qend - qstart) + 1) * 100 / CAST(qlen AS DOUBLE) + 0.5) AS BIGINT) AS coverage FROM hsps WHERE qend <= qlen AND pident <= 100 AND (abs(qend - qstart) + 1) * 100 >= 50 * qlen",
    "d07_qscore_filter": "SELECT read_id, qscore FROM reads WHERE qscore IS NOT NULL AND qscore >= 15",
    "d08_kingdom_consistency": "SELECT b.hash, b.subject FROM best b LEFT JOIN lineage l ON b.subject = l.subject WHERE l.kingdom IS NULL OR l.kingdom = 'Metazoa'",
    "d09_level_qualification": "SELECT hash, species, CASE WHEN species = 'NA' THEN false WHEN pident >= 95 THEN true ELSE false END AS species_ok, CASE WHEN genus = 'NA' THEN false ELSE pident >= 93 END AS genus_ok FROM hits",
    "d10_identity_mask": "SELECT hash, family, CASE WHEN pident >= 93 THEN genus ELSE 'Unassigned' END AS genus, CASE WHEN pident >= 95 THEN species ELSE 'Unassigned' END AS species FROM hits",
    "d13_model_preference": "SELECT read_id, model FROM reads WHERE model IN ('sup', 'hac2sup') OR NOT EXISTS (SELECT 1 FROM reads r2 WHERE r2.model IN ('sup', 'hac2sup'))",
    "d16_min_support": "SELECT genus, count(*) AS n FROM hits WHERE genus <> 'NA' GROUP BY genus HAVING count(*) >= 5",
    "d17_input_decision": "SELECT CASE WHEN total = 0 THEN 'skip' WHEN missing / CAST(total AS DOUBLE) > 0.1 THEN 'full' ELSE 'filtered' END AS decision, total, missing FROM (SELECT count(*) AS total, count(*) - count(qscore) AS missing FROM reads) AS x",
    "d18_effective_mode": "SELECT round, CASE WHEN round <= 3 THEN 'all' ELSE 'filtered' END AS mode FROM (SELECT DISTINCT round FROM rounds) AS x",
    "d21_eligible_reads": "SELECT r.read_id, r.sample, r.model FROM reads r JOIN (SELECT sample, sum(CASE WHEN model IN ('sup', 'hac2sup') THEN 1 ELSE 0 END) AS good FROM reads GROUP BY sample) s ON r.sample = s.sample WHERE r.model IN ('sup', 'hac2sup') OR (s.good < 20 AND r.model = 'hac')",
    # joins
    "e01_summary_target_report": "SELECT o.o_orderkey AS read_id, coalesce(x.marker, 'unmatched') AS marker FROM orders o LEFT JOIN (SELECT read_id, min(marker) AS marker FROM members GROUP BY read_id) x ON o.o_orderkey = x.read_id",
    "e05_members_first_demux": "SELECT m.otu, m.read_id, coalesce(d.c_mktsegment, 'unknown') AS sample FROM members m LEFT JOIN (SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate, o_custkey) AS nth FROM orders) AS y WHERE nth = 1) o ON m.read_id = o.o_orderkey LEFT JOIN customer d ON o.o_custkey = d.c_custkey",
    "e09_membership_parity": "SELECT coalesce(a.read_id, b.read_id) AS read_id, CASE WHEN a.read_id IS NULL THEN 'extra' ELSE 'missing' END AS problem FROM (SELECT DISTINCT read_id FROM members) a FULL OUTER JOIN (SELECT o_orderkey AS read_id FROM orders WHERE o_orderstatus <> 'P') b ON a.read_id = b.read_id WHERE a.read_id IS NULL OR b.read_id IS NULL",
    "e12_semi_join_ids": "SELECT r.read_id, r.marker FROM reads r WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.doc_id AND l.quality = 1)",
    "e13_anti_join_prune": "SELECT r.read_id FROM reads r WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.doc_id AND l.quality = 0)",
    "e15_keys_to_members": "SELECT otu, read_id FROM members WHERE otu % 10 = 1 UNION SELECT m.otu, m.read_id FROM members m JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) s ON m.otu = s.s_suppkey",
    "e18_scoped_prune_keep": "SELECT m.otu, m.read_id FROM members m WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = m.otu AND s.s_acctbal < 0)",
    "e19_recovered_reads": "SELECT DISTINCT m.read_id FROM members m JOIN supplier s ON m.otu = s.s_suppkey WHERE s.s_nationkey = 7",
    # aggregations
    "f01_column_counts": "SELECT count(*) AS n_rows, count(DISTINCT sample) AS samples, count(qscore) AS scored, count(CASE WHEN model = 'sup' THEN 1 END) AS sup FROM reads",
    "f02_hash_multiplicity": "SELECT md5(upper(header)) AS hash, count(*) AS n FROM headers GROUP BY md5(upper(header))",
    "f03_otu_size": "SELECT otu, count(DISTINCT read_id) AS size FROM members GROUP BY otu",
    "f04_cluster_size_by_hash": "SELECT m.otu, count(*) AS size FROM members m JOIN (SELECT read_id FROM members GROUP BY read_id HAVING count(DISTINCT otu) = 1) u ON m.read_id = u.read_id GROUP BY m.otu HAVING count(*) >= 3",
    "f05_taxonomy_metrics": "SELECT marker, sample, count(*) AS n, count(qscore) AS scored, CASE WHEN count(*) = 0 THEN NULL ELSE round(count(qscore) / CAST(count(*) AS DOUBLE), 6) END AS fraction FROM reads GROUP BY GROUPING SETS ((), (marker), (marker, sample))",
    "f06_assignments_by_level": "SELECT genus, count(DISTINCT hash) AS otus, count(*) AS n_rows, min(pident) AS pident_min, max(pident) AS pident_max, min(CASE WHEN species = 'NA' THEN NULL ELSE species END) AS species FROM hits WHERE genus <> 'NA' GROUP BY genus",
    "f10_otu_by_marker_assigned": "SELECT marker, count(DISTINCT otu) AS otus, count(DISTINCT CASE WHEN otu % 3 = 0 THEN otu END) AS assigned FROM members GROUP BY marker",
    "f11_treemap": "SELECT l.family AS class, l.genus AS taxon, count(*) AS n, count(DISTINCT b.hash) AS clusters FROM best b JOIN lineage l ON b.subject = l.subject GROUP BY l.family, l.genus",
    "f12_detection_rule": "SELECT taxon, count(*) AS samples FROM (SELECT o_custkey AS sample, o_orderpriority AS taxon, count(*) AS n FROM orders GROUP BY o_custkey, o_orderpriority) AS x WHERE n > 9 GROUP BY taxon",
    "f13_demux_summary": "SELECT marker, sample, model, count(*) AS read_count FROM reads GROUP BY marker, sample, model",
    "f14_provenance_max": "SELECT otu, max(amount) AS reads_used FROM rounds GROUP BY otu",
    "f15_round_reads_sum": "SELECT marker, CASE WHEN count(*) = 0 THEN 0 WHEN count(qscore) = 0 THEN NULL ELSE CAST(sum(qscore) AS BIGINT) END AS total FROM reads GROUP BY marker",
    "f16_competition_summary": "SELECT d.status, d.model, coalesce(n, 0) AS n FROM (SELECT * FROM (SELECT 'low' AS status UNION ALL SELECT 'high' UNION ALL SELECT 'none') a CROSS JOIN (SELECT DISTINCT model FROM reads) b) d LEFT JOIN (SELECT model, CASE WHEN qscore < 15 THEN 'low' ELSE 'high' END AS status, count(*) AS n FROM reads GROUP BY 1, 2) x ON d.status = x.status AND d.model = x.model",
    "f17_lock_summary": "SELECT round, count(*) AS otus, count(CASE WHEN n >= 5 THEN 1 END) AS locked, max(n) AS largest FROM sized GROUP BY round",
    "f18_run_totals": "SELECT marker, CASE WHEN count(qscore) = count(*) THEN CAST(sum(qscore) AS BIGINT) END AS total, count(*) AS n FROM reads GROUP BY marker",
    "f20_tree_totals": "SELECT family, genus, species, count(*) AS n FROM hits GROUP BY GROUPING SETS ((family), (family, genus), (family, genus, species))",
    "f22_frozen_counts": "SELECT rank_name, count(DISTINCT name) AS n FROM (SELECT 'family' AS rank_name, family AS name FROM hits UNION ALL SELECT 'genus', genus FROM hits WHERE genus <> 'NA' UNION ALL SELECT 'species', species FROM hits WHERE species <> 'NA') AS x GROUP BY rank_name",
    "f24_model_counts": "SELECT count(CASE WHEN model = 'fast' THEN 1 END) AS fast, count(CASE WHEN model = 'hac' THEN 1 END) AS hac, count(CASE WHEN model IN ('sup', 'hac2sup') THEN 1 END) AS sup FROM reads",
    "f26_preflight_stats": "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS reads, count(*) - count(DISTINCT l_suppkey * 100000000 + l_orderkey) AS duplicates FROM lineitem",
    "f27_work_list": "SELECT sample, marker, count(*) AS n FROM reads GROUP BY sample, marker HAVING count(*) >= 3",
    "f28_cumulative_counters": "SELECT count(DISTINCT o.o_orderkey) AS seen, count(DISTINCT CASE WHEN m.read_id IS NOT NULL THEN o.o_orderkey END) AS matched FROM orders o LEFT JOIN members m ON o.o_orderkey = m.read_id",
    # ranking
    "g01_first_hit": "SELECT hash, subject, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY ordinal, subject) AS nth FROM hsps) AS x WHERE nth = 1",
    "g02_target_competition": "SELECT hash, target, off_target, target - off_target AS margin, CASE WHEN off_target IS NULL THEN 'target_only' WHEN target IS NULL THEN 'offtarget_only' WHEN target > off_target THEN 'target_leads' WHEN target < off_target THEN 'offtarget_leads' ELSE 'tie' END AS status FROM (SELECT h.hash, max(CASE WHEN l.family LIKE 'E%' THEN bitscore END) AS target, max(CASE WHEN l.family NOT LIKE 'E%' THEN bitscore END) AS off_target FROM hsps h JOIN lineage l ON h.subject = l.subject GROUP BY h.hash) AS x",
    "g04_pool_prefer_new": "SELECT base, doc_id, model FROM (SELECT doc_id % 200 AS base, doc_id, model, row_number() OVER (PARTITION BY doc_id % 200 ORDER BY CASE model WHEN 'sup' THEN 3 WHEN 'hac' THEN 2 WHEN 'fast' THEN 1 ELSE 0 END DESC, doc_id DESC) AS nth FROM reads) AS x WHERE nth = 1",
    "g06_best_read_info": "SELECT sample, doc_id, model, qscore FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY CASE model WHEN 'sup' THEN 4 WHEN 'hac2sup' THEN 3 WHEN 'hac' THEN 2 WHEN 'fast' THEN 1 ELSE 0 END DESC, coalesce(qscore, -1) DESC, doc_id) AS nth FROM reads) AS x WHERE nth = 1",
    "g07_representative_read": "SELECT seq_hash, doc_id FROM (SELECT md5(seq) AS seq_hash, doc_id, row_number() OVER (PARTITION BY md5(seq) ORDER BY coalesce(qscore, -1) DESC, doc_id) AS nth FROM reads) AS x WHERE nth = 1",
    "g09_top_paths": "SELECT family, genus, n FROM (SELECT family, genus, count(*) AS n, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, genus) AS nth FROM hits GROUP BY family, genus) AS x WHERE nth <= 5",
    "g11_unassigned_top_k": "SELECT sample, doc_id FROM (SELECT sample, doc_id, row_number() OVER (PARTITION BY sample ORDER BY len DESC, coalesce(qscore, -1) DESC, doc_id) AS nth FROM reads) AS x WHERE nth <= 5",
    "g12_promote_top_reads": "SELECT otu, read_id, CASE WHEN nth <= 50 THEN 'sup' ELSE 'hac_fixed' END AS model FROM (SELECT otu, read_id, row_number() OVER (PARTITION BY otu ORDER BY read_id % 97 DESC, read_id) AS nth FROM (SELECT DISTINCT otu, read_id FROM members) AS d) AS x",
    "g13_canonical_taxonomy_row": "SELECT hash, subject, pident, length FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY pident DESC, length DESC, subject, ordinal) AS nth FROM hsps) AS x WHERE nth = 1",
    "g15_voucher_best": "SELECT sample, marker, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY sample, marker ORDER BY len DESC, doc_id) AS nth FROM reads) AS x WHERE nth = 1",
    "g18_cluster_gap": "SELECT sample, max(CASE WHEN nth = 1 THEN n END) AS top1, max(CASE WHEN nth = 2 THEN n END) AS top2, max(CASE WHEN nth = 1 THEN n END) - max(CASE WHEN nth = 2 THEN n END) AS delta FROM (SELECT sample, marker, count(*) AS n, row_number() OVER (PARTITION BY sample ORDER BY count(*) DESC, marker) AS nth FROM reads GROUP BY sample, marker) AS x WHERE nth <= 2 GROUP BY sample",
    "g19_edge_dedup": "SELECT a, b, bitscore FROM (SELECT least(hash, subject) AS a, greatest(hash, subject) AS b, bitscore, row_number() OVER (PARTITION BY least(hash, subject), greatest(hash, subject) ORDER BY bitscore DESC) AS nth FROM hsps) AS x WHERE nth = 1",
    "g21_cumulative_reads": "SELECT marker, round, n, CAST(sum(n) OVER (PARTITION BY marker ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative FROM (SELECT marker, round, count(*) AS n FROM rounds GROUP BY marker, round) AS x",
    "g22_latest_previous_round": "SELECT otu, round AS latest, previous FROM (SELECT otu, round, lag(round) OVER (PARTITION BY otu ORDER BY round) AS previous, row_number() OVER (PARTITION BY otu ORDER BY round DESC) AS nth FROM (SELECT DISTINCT otu, round FROM rounds) AS d) AS x WHERE nth = 1",
    "g24_drop_zero_series": "SELECT otu, round, n FROM (SELECT otu, round, n, max(n) OVER (PARTITION BY otu) AS top FROM sized WHERE marker = 'error') AS x WHERE top > 1",
    "g26_best_of_consolidated": "SELECT sample, doc_id FROM (SELECT sample, doc_id, row_number() OVER (PARTITION BY sample ORDER BY len DESC, doc_id) AS nth FROM (SELECT *, CASE WHEN model = 'sup' THEN 1 ELSE 0 END AS flag, max(CASE WHEN model = 'sup' THEN 1 ELSE 0 END) OVER (PARTITION BY sample) AS any_flag FROM reads) AS y WHERE flag = any_flag) AS x WHERE nth = 1",
    "g27_top_samples": "SELECT sample, count(*) AS n FROM reads GROUP BY sample ORDER BY n DESC, sample LIMIT 10",
    "g28_max_identity": "SELECT hash, max(pident) AS pident FROM hsps GROUP BY hash",
    "h02_assignment_order": "SELECT genus, n, CAST(row_number() OVER (ORDER BY n DESC, genus) AS BIGINT) AS place FROM (SELECT genus, count(*) AS n FROM hits GROUP BY genus) AS x",
    # sets
    "i01_prune_union": "SELECT otu FROM members WHERE marker = 'R' AND otu % 7 = 0 UNION SELECT otu FROM members WHERE otu % 5 = 0",
    "i02_prune_minus_protected": "SELECT DISTINCT otu FROM members WHERE otu % 3 = 0 EXCEPT SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000",
    "i03_prune_recovery_overlap": "SELECT count(*) AS recovered FROM (SELECT DISTINCT otu FROM members WHERE otu % 3 = 0 INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) AS x",
    "i06_append_unique_pairs": "SELECT DISTINCT m.otu, m.read_id FROM members m WHERE m.marker = 'A' AND NOT EXISTS (SELECT 1 FROM members o WHERE o.otu = m.otu AND o.read_id = m.read_id AND o.marker = 'N')",
    "i09_otu_fate_remainder": "SELECT DISTINCT otu FROM members EXCEPT SELECT s_suppkey FROM supplier WHERE s_nationkey < 5 EXCEPT SELECT s_suppkey FROM supplier WHERE s_acctbal < 0",
    # taxonomy
    "j08_legacy_cluster_taxid": "SELECT hash, CASE WHEN count(*) = 1 THEN min(genus) ELSE 'NA' END AS genus FROM (SELECT hash, genus, rank() OVER (PARTITION BY hash ORDER BY count(*) DESC) AS place FROM hits GROUP BY hash, genus) AS x WHERE place = 1 GROUP BY hash",
    "j11_assigned_at_level": "SELECT hash, max(CASE WHEN species <> 'NA' THEN 6 WHEN genus <> 'NA' THEN 5 ELSE 4 END) AS depth FROM hits GROUP BY hash",
    "j12_assigned_sets": "SELECT hash, max(CASE WHEN genus <> 'NA' THEN 1 ELSE 0 END) = 1 AS assigned FROM hits GROUP BY hash",
    "j13_lineage_authority": "SELECT genus, count(DISTINCT family) AS families, CASE WHEN count(DISTINCT family) = 1 THEN min(family) END AS family FROM lineage WHERE genus <> 'NA' GROUP BY genus",
    "j15_sample_mode": "SELECT sample, CASE WHEN max(CASE WHEN doc_id % 5 <> 0 THEN 1 ELSE 0 END) = 1 THEN 'barcoded' ELSE 'no_adapter_only' END AS mode FROM reads GROUP BY sample",
    # clustering
    "k01_new_by_hash": "SELECT seq_hash, doc_id FROM (SELECT md5(seq) AS seq_hash, doc_id, row_number() OVER (PARTITION BY md5(seq) ORDER BY doc_id) AS nth FROM reads) AS x WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM reads o WHERE o.doc_id < 100 AND md5(o.seq) = x.seq_hash)",
    "k13_exact_groups": "SELECT md5(seq) AS seq_hash, count(*) AS n, min(doc_id) AS first_id FROM reads GROUP BY md5(seq)",
    # rounds
    "l01_round_index": "SELECT round, CAST(dense_rank() OVER (ORDER BY round) AS BIGINT) AS round_index FROM (SELECT DISTINCT round FROM rounds) AS x",
    "l03_first_seen": "SELECT otu, min(round) AS first_round FROM rounds GROUP BY otu",
    "l04_sticky_state": "SELECT otu, max(CASE WHEN marker = 'purchase' THEN 1 ELSE 0 END) = 1 AS on_target, max_by(marker, event_id) AS last_marker FROM rounds GROUP BY otu",
    "l08_grace_windows": "SELECT round, CASE WHEN round <= 3 THEN 'skipped' WHEN round <= 6 THEN 'grace' ELSE 'enforced' END AS state, count(*) AS n FROM rounds GROUP BY 1, 2",
    "l11_run_freshness": "SELECT otu, age, cadence, CASE WHEN cadence IS NULL THEN 'Unknown' WHEN age <= 1.5 * cadence THEN 'Fresh' WHEN age <= 3 * cadence THEN 'Aging' ELSE 'Stale' END AS status FROM (SELECT otu, 31 - round AS age, round - previous AS cadence FROM (SELECT otu, round, lag(round) OVER (PARTITION BY otu ORDER BY round) AS previous, row_number() OVER (PARTITION BY otu ORDER BY round DESC) AS nth FROM (SELECT DISTINCT otu, round FROM rounds) AS d) AS y WHERE nth = 1) AS x",
    "l19_sparse_marker_rescue": "SELECT r.read_id, r.marker FROM reads r JOIN (SELECT marker, count(CASE WHEN len > 4000 THEN 1 END) AS kept FROM reads GROUP BY marker) c ON r.marker = c.marker WHERE r.len > 4000 OR c.kept < 60",
    # reports
    "n01_read_fate": "SELECT status, count(*) AS n FROM (SELECT o.o_orderkey, CASE WHEN m.read_id IS NULL THEN 'off_target' WHEN o.o_orderstatus = 'P' THEN 'skipped' WHEN o.o_totalprice < 50000 THEN 'not_demultiplexed' ELSE 'assigned' END AS status FROM orders o LEFT JOIN (SELECT DISTINCT read_id FROM members) m ON o.o_orderkey = m.read_id) AS x GROUP BY status",
    "n06_reads_over_time": "SELECT round, count(*) AS n, count(DISTINCT otu) AS otus FROM rounds GROUP BY round",
    "n10_quality_long_form": "SELECT doc_id, 'len' AS measure, CAST(len AS BIGINT) AS value FROM reads UNION ALL SELECT doc_id, 'qscore', CAST(qscore AS BIGINT) FROM reads WHERE qscore IS NOT NULL",
    "n16_duplicate_metadata": "SELECT c_name, CASE WHEN n = 1 THEN 'unique' WHEN k = 1 THEN 'exact_duplicate_collapsed' ELSE 'conflict' END AS status FROM (SELECT c_mktsegment AS c_name, count(*) AS n, count(DISTINCT c_nationkey) AS k FROM customer GROUP BY c_mktsegment) AS x",
    # integrity: each gives its violations
    "o01_key_unique": "SELECT l_orderkey AS read_id, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "o03_functional_dependency": "SELECT genus, count(DISTINCT family) AS n FROM lineage GROUP BY genus HAVING count(DISTINCT family) > 1",
    "o06_stage_order": "SELECT count(*) AS total, count(m.read_id) AS on_target, count(*) >= count(m.read_id) AS sound FROM orders o LEFT JOIN (SELECT DISTINCT read_id FROM members) m ON o.o_orderkey = m.read_id",
    **evidence.PLANS,
}


def _plan(sql: str):
    return lambda spark, sf_dir: spark.sql(adapters.spark(sql, sf_dir))


_view = adapters.view


def c_header_fields(spark, sf_dir):
    h = _view(spark, sf_dir, "headers")
    return h.select("doc_id", S.base_read_id("header").alias("base_id"), S.header_model("header").alias("model"), S.model_rank(S.header_model("header")).cast("long").alias("model_rank"), S.keyed_token("header", "barcode").alias("barcode"), S.sample_label(S.keyed_token("header", "adapter")).alias("adapter"))


def c_sequence_functions(spark, sf_dir):
    h = _view(spark, sf_dir, "headers")
    dna = F.translate(F.upper(F.md5("header")), "0123456789BDEF", "ACGTACGTACGTAC")
    return h.select("doc_id", S.seq_hash("header").alias("seq_hash"), S.reverse_complement(dna).alias("reverse"), S.slug("header").alias("slug"))


def g03_best_hsp_with_ties(spark, sf_dir):
    return ranking.best_hsps(_view(spark, sf_dir, "hsps")).select("hash", "subject", "bitscore", "evalue", "length", "pident")


def g10_rank_until_quota(spark, sf_dir):
    groups = _view(spark, sf_dir, "reads").groupBy("sample", "marker").agg(F.count("*").alias("n"), F.max("qscore").alias("q"))
    return ranking.until_quota(groups, ["sample"], [F.desc_nulls_last("q"), F.desc("n"), F.asc("marker")], "n", 20)


def _hits(spark, sf_dir):
    hits = _view(spark, sf_dir, "hits")
    return hits.select("hash", "pident", *[taxonomy.known(F.col(x)).alias(x) for x in ("family", "genus", "species")])


def j01_identity_tier(spark, sf_dir):
    names = {x: F.col(x) for x in ("family", "genus", "species")}
    return _hits(spark, sf_dir).select("hash", "pident", taxonomy.identity_tier(F.col("pident"), 93, 95, names).alias("name")).distinct()


def j05_lineage_lca(spark, sf_dir):
    return taxonomy.common_lineage(_hits(spark, sf_dir), ["hash"], ["family", "genus", "species"])


def j07_plurality_vote(spark, sf_dir):
    return taxonomy.plurality(_hits(spark, sf_dir), ["hash"], ["family", "genus", "species"])


def k07_components(spark, sf_dir):
    edges = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 49 and l_discount > 0.08")
    return connected_components(edges.select(F.col("l_orderkey").alias("src"), (-F.col("l_partkey")).alias("dst")))


def k07_components_all(spark, sf_dir):
    """Components over every lineitem edge; SQL's recursive closure cannot hold them, so tests compare with union-find."""
    edges = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return connected_components(edges.select(F.col("l_orderkey").alias("src"), (-F.col("l_partkey")).alias("dst")))


def l05_freeze_promotion(spark, sf_dir):
    sized = _view(spark, sf_dir, "sized").groupBy("otu", "round").agg(F.sum("n").alias("n"))
    return rounds.promotions(sized, ["otu"], "n")


def l06_size_streak(spark, sf_dir):
    small = _view(spark, sf_dir, "sized").where("n = 1").select("otu", "marker", "round")
    return rounds.streaks(small, ["otu", "marker"]).withColumn("prune", F.col("streak") >= 3)


def n04_assignments_by_level(spark, sf_dir):
    """Best alignments with ties, resolved to their common lineage, then counted per family, genus and species."""
    resolved = j05_lineage_lca(spark, sf_dir)
    return resolved.groupBy("family", "genus", "species").agg(F.count("*").alias("otus"), F.sum(F.when(F.col("status") == "ASSIGNED", 1).otherwise(0)).alias("assigned"))


FLAGSHIP = n04_assignments_by_level

_KNOWN = "SELECT hash, pident, family, nullif(genus, 'NA') AS genus, nullif(species, 'NA') AS species FROM hits"
_LCA = f"""SELECT hash, CASE WHEN nf = 1 AND kf = n THEN family END AS family, CASE WHEN nf <= 1 AND ng = 1 AND kg = n THEN genus END AS genus, CASE WHEN nf <= 1 AND ng <= 1 AND ns = 1 AND ks = n THEN species END AS species,
 CAST(CASE WHEN nf <= 1 AND ng <= 1 AND ns = 1 AND ks = n THEN 2 WHEN nf <= 1 AND ng = 1 AND kg = n THEN 1 WHEN nf = 1 AND kf = n THEN 0 ELSE -1 END AS BIGINT) AS depth, kinds
 FROM (SELECT hash, count(*) AS n, count(DISTINCT concat_ws('/', family, coalesce(genus, '-'), coalesce(species, '-'))) AS kinds, count(DISTINCT family) AS nf, count(family) AS kf, min(family) AS family, count(DISTINCT genus) AS ng, count(genus) AS kg, min(genus) AS genus, count(DISTINCT species) AS ns, count(species) AS ks, min(species) AS species FROM ({_KNOWN}) GROUP BY hash)"""
_LCA = f"SELECT hash, family, genus, species, depth, CASE WHEN depth < 0 THEN 'REFERENCE_UNRESOLVED' WHEN kinds = 1 THEN 'ASSIGNED' ELSE 'AMBIGUOUS_TIE' END AS status FROM ({_LCA})"

BUILT = {
    "c_header_fields": (c_header_fields, """SELECT doc_id, split_part(header, '|', 1) AS base_id, model, CAST(CASE model WHEN 'sup' THEN 3 WHEN 'hac' THEN 2 WHEN 'fast' THEN 1 ELSE 0 END AS BIGINT) AS model_rank, barcode, CASE WHEN starts_with(adapter, 'no_adapter_') THEN 'no_adapter' ELSE adapter END AS adapter
 FROM (SELECT doc_id, header, CASE WHEN lower(split_part(header, '|', 3)) IN ('hac_fixed', 'hac2sup') THEN 'hac' ELSE lower(split_part(header, '|', 3)) END AS model, substr(split_part(header, '|', 4), 9) AS barcode, substr(split_part(header, '|', 5), 9) AS adapter FROM headers)"""),
    "c_sequence_functions": (c_sequence_functions, """SELECT doc_id, md5(upper(header)) AS seq_hash, translate(reverse(translate(upper(md5(header)), '0123456789BDEF', 'ACGTACGTACGTAC')), 'ACGT', 'TGCA') AS reverse, regexp_replace(regexp_replace(regexp_replace(lower(header), '[^a-z0-9._-]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') AS slug FROM headers"""),
    "g03_best_hsp_with_ties": (g03_best_hsp_with_ties, "SELECT hash, subject, bitscore, evalue, length, pident FROM best"),
    "g10_rank_until_quota": (g10_rank_until_quota, "SELECT sample, marker, n, q FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY sample ORDER BY q DESC NULLS LAST, n DESC, marker ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT sample, marker, count(*) AS n, max(qscore) AS q FROM reads GROUP BY sample, marker)) WHERE before < 20"),
    "j01_identity_tier": (j01_identity_tier, f"SELECT DISTINCT hash, pident, CASE WHEN pident < 93 THEN family WHEN pident < 95 THEN coalesce(genus, family) ELSE coalesce(species, genus, family) END AS name FROM ({_KNOWN})"),
    "j05_lineage_lca": (j05_lineage_lca, _LCA),
    "j07_plurality_vote": (j07_plurality_vote, f"""SELECT hash, f AS family, CASE WHEN f IS NULL THEN NULL ELSE g END AS genus, CASE WHEN f IS NULL OR many_g THEN NULL ELSE s END AS species,
 CAST(CASE WHEN f IS NULL THEN -1 WHEN NOT many_g AND s IS NOT NULL THEN 2 WHEN g IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS depth, CASE WHEN f IS NULL THEN 'REFERENCE_UNRESOLVED' WHEN winners = 1 THEN 'ASSIGNED' ELSE 'AMBIGUOUS_TIE' END AS status, votes, winners
 FROM (SELECT hash, max(votes) AS votes, count(*) AS winners, CASE WHEN len(list_distinct(list(family))) = 1 THEN any_value(family) END AS f, CASE WHEN len(list_distinct(list(coalesce(genus, '-')))) = 1 THEN any_value(genus) END AS g, len(list_distinct(list(genus))) > 1 AS many_g,
 CASE WHEN len(list_distinct(list(coalesce(species, '-')))) = 1 THEN any_value(species) END AS s FROM (SELECT hash, family, genus, species, count(*) AS votes, rank() OVER (PARTITION BY hash ORDER BY count(*) DESC) AS place FROM ({_KNOWN}) GROUP BY hash, family, genus, species) WHERE place = 1 GROUP BY hash)"""),
    "k07_components": (k07_components, "WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS a, -l_partkey AS b FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.08), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a) SELECT node, min(seen) AS component FROM r GROUP BY node"),
    "l05_freeze_promotion": (l05_freeze_promotion, """SELECT otu, rounds, reads, rounds >= 3 AND reads >= 50 AND (rounds < 3 OR fell = 0) AS promoted FROM (SELECT otu, count(*) AS rounds, CAST(sum(n) AS BIGINT) AS reads, max(CASE WHEN back < 3 AND before > 0 AND n < 0.75 * before THEN 1 ELSE 0 END) AS fell
 FROM (SELECT otu, round, n, lag(n) OVER (PARTITION BY otu ORDER BY round) AS before, row_number() OVER (PARTITION BY otu ORDER BY round DESC) AS back FROM (SELECT otu, round, sum(n) AS n FROM sized GROUP BY otu, round)) GROUP BY otu)"""),
    "l06_size_streak": (l06_size_streak, "SELECT otu, marker, round, streak, streak >= 3 AS prune FROM (SELECT otu, marker, round, row_number() OVER (PARTITION BY otu, marker, island ORDER BY round) AS streak FROM (SELECT *, round - row_number() OVER (PARTITION BY otu, marker ORDER BY round) AS island FROM (SELECT otu, marker, round FROM sized WHERE n = 1)))"),
    "n04_assignments_by_level": (n04_assignments_by_level, f"SELECT family, genus, species, count(*) AS otus, CAST(sum(CASE WHEN status = 'ASSIGNED' THEN 1 ELSE 0 END) AS BIGINT) AS assigned FROM ({_LCA}) GROUP BY family, genus, species"),
    **built.BUILT,
}

QUERIES = {**{k: _plan(v) for k, v in PLANS.items()}, **{k: f for k, (f, _) in BUILT.items()}}
ORACLES = {**{k: adapters.duckdb(v) for k, v in PLANS.items()}, **{k: sql if sql.startswith("WITH") else adapters.duckdb(sql) for k, (_, sql) in BUILT.items()}}
#: Queries without SQL of their own.
WHOLE = {"k07_components_all": k07_components_all}
