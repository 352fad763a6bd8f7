"""Plans on evidence, membership and state that join, rank or reconcile several tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

_SIZED = "SELECT otu, round, CAST(sum(n) AS BIGINT) AS n FROM sized GROUP BY otu, round"
_EXCLUDED = "SELECT DISTINCT read_id FROM members WHERE marker = 'R'"

PLANS = {
    # filters
    "d11_adapter_class": "SELECT doc_id, CASE WHEN header LIKE '%adapter=no_adapter%' THEN 'no_adapter' ELSE 'adapter' END AS adapter_class FROM headers",
    "d12_unit_marker_mismatch": "SELECT r.event_id, r.otu, r.marker FROM rounds r JOIN (SELECT otu, min(marker) AS expected FROM rounds WHERE round <= 2 GROUP BY otu HAVING count(DISTINCT marker) = 1) u ON r.otu = u.otu WHERE r.marker = u.expected",
    "d14_collapse_exclusion": f"SELECT m.otu, m.read_id FROM members m LEFT JOIN ({_EXCLUDED}) x ON m.read_id = x.read_id WHERE x.read_id IS NULL",
    "d14_affected_otus": f"SELECT DISTINCT m.otu FROM members m JOIN ({_EXCLUDED}) x ON m.read_id = x.read_id",
    "d15_interest_filter": "SELECT hash, genus FROM hits WHERE genus IN (SELECT p_brand FROM part WHERE p_size > 49) OR NOT EXISTS (SELECT 1 FROM part WHERE p_size > 49)",
    "d19_pool_retention": "SELECT h.doc_id FROM headers h LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) p ON h.doc_id = p.doc_id WHERE p.doc_id IS NOT NULL OR (lower(h.header) LIKE '%|sup|%' AND h.header NOT LIKE '%adapter=no_adapter%')",
    # joins
    "e02_hac_summary": "SELECT r.read_id, coalesce(CAST(h.qscore AS STRING), 'NA') AS hac_qscore, coalesce(CAST(h.len AS STRING), 'NA') AS hac_length FROM reads r LEFT JOIN (SELECT read_id, qscore, len FROM reads WHERE model = 'hac') h ON r.read_id = h.read_id",
    "e03_sup_summary": "SELECT r.read_id, coalesce(CAST(h.qscore AS STRING), 'NA') AS sup_qscore, coalesce(CAST(h.len AS STRING), 'NA') AS sup_length FROM reads r LEFT JOIN (SELECT read_id, qscore, len FROM reads WHERE model = 'sup') h ON r.read_id = h.read_id",
    "e04_annotated_ids": "SELECT m.read_id, concat(CAST(m.read_id AS STRING), '|', m.marker) AS new_id FROM members m JOIN orders o ON m.read_id = o.o_orderkey WHERE o.o_orderstatus = 'F'",
    "e06_exact_then_base": "SELECT m.otu, m.read_id, coalesce(x.label, b.label) AS label, CASE WHEN x.label IS NOT NULL THEN 'exact' WHEN b.label IS NOT NULL THEN 'base' ELSE 'missing' END AS via FROM members m LEFT JOIN (SELECT o_orderkey AS read_id, min(o_orderpriority) AS label FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderkey) x ON m.read_id = x.read_id LEFT JOIN (SELECT s_suppkey AS otu, CAST(s_nationkey AS STRING) AS label FROM supplier WHERE s_acctbal > 0) b ON m.otu = b.otu",
    "e07_annotated_hits": "SELECT m.otu, m.read_id, b.subject, b.pident FROM members m JOIN best b ON m.read_id = b.hash",
    "e08_consolidated_hits": "SELECT h.hash, h.genus, h.pident FROM hits h WHERE EXISTS (SELECT 1 FROM members m WHERE m.read_id = h.hash AND m.marker = 'A')",
    "e10_member_evidence": "SELECT m.otu, m.read_id, CASE WHEN b.hash IS NULL THEN 'inherited' ELSE 'direct' END AS evidence, b.pident FROM (SELECT DISTINCT otu, read_id FROM members) m LEFT JOIN (SELECT hash, max(pident) AS pident FROM best WHERE pident >= 95 GROUP BY hash) b ON m.read_id = b.hash",
    "e14_frozen_by_hash": "SELECT DISTINCT f.seq_hash, f.frozen_id FROM (SELECT md5(seq) AS seq_hash FROM reads) r JOIN (SELECT md5(seq) AS seq_hash, min(doc_id) AS frozen_id FROM reads WHERE model = 'sup' GROUP BY md5(seq)) f ON r.seq_hash = f.seq_hash",
    "e16_blocked_otus": "SELECT m.otu, m.read_id FROM members m JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) s ON m.otu = s.s_suppkey UNION SELECT m.otu, m.read_id FROM members m JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') o ON m.read_id = o.o_orderkey",
    "e20_voucher_provenance": "SELECT r.doc_id, CASE WHEN l.doc_id IS NULL THEN 'absent' WHEN l.quality = 1 THEN 'match' ELSE 'mismatch' END AS provenance FROM reads r LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON r.doc_id = l.doc_id",
    "e21_positional_audit": "SELECT hash, ordinal, CAST(place AS BIGINT) AS place FROM (SELECT hash, ordinal, row_number() OVER (PARTITION BY hash ORDER BY ordinal, subject) AS place FROM hsps) AS x WHERE ordinal <> place",
    "e23_identity_map": "SELECT m.otu, m.read_id, i.s_name AS stable_key FROM members m JOIN (SELECT s_suppkey, min(s_name) AS s_name FROM supplier GROUP BY s_suppkey HAVING count(*) = 1) i ON m.otu = i.s_suppkey",
    "e24_prefer_real_rows": f"SELECT otu, round, n, false AS placeholder FROM ({_SIZED}) AS s UNION ALL SELECT u.otu, r.round, CAST(0 AS BIGINT), true FROM (SELECT DISTINCT otu FROM rounds WHERE marker = 'error') u CROSS JOIN (SELECT max(round) AS round FROM rounds) r LEFT JOIN ({_SIZED}) s ON s.otu = u.otu AND s.round = r.round WHERE s.otu IS NULL",
    "e27_disposition": "SELECT a.p_partkey AS reference, a.tier, a.status, coalesce(p.action, 'unmapped') AS action FROM (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'priority' ELSE 'review' END AS tier, CASE WHEN p_retailprice > 1500 THEN 'confirmed' ELSE 'open' END AS status FROM part) a LEFT JOIN (SELECT 'priority' AS tier, 'confirmed' AS status, 'quarantine' AS action UNION ALL SELECT 'priority', 'open', 'retain' UNION ALL SELECT 'review', 'open', 'retain') p ON a.tier = p.tier AND a.status = p.status",
    # aggregates
    "f07_consensus_by_level": "SELECT family, count(DISTINCT hash) AS consensus, count(DISTINCT CASE WHEN genus <> 'NA' THEN genus END) AS genera, count(DISTINCT CASE WHEN species <> 'NA' THEN species END) AS species_n, max(pident) AS pident_max FROM hits GROUP BY family",
    "f08_fate_by_marker": "SELECT m.marker, count(*) AS reads, count(CASE WHEN o.o_orderstatus = 'P' THEN 1 END) AS skipped, count(CASE WHEN o.o_orderkey IS NULL THEN 1 END) AS unknown FROM members m LEFT JOIN (SELECT o_orderkey, min(o_orderstatus) AS o_orderstatus FROM orders GROUP BY o_orderkey) o ON m.read_id = o.o_orderkey GROUP BY m.marker",
    "f09_sample_metrics": "SELECT sample, marker, model, count(DISTINCT read_id) AS reads, count(CASE WHEN qscore >= 15 THEN 1 END) AS good FROM reads GROUP BY GROUPING SETS ((sample), (sample, marker), (sample, marker, model))",
    "f19_prune_source_stats": "SELECT marker AS prune_source, count(DISTINCT otu) AS n FROM members GROUP BY marker UNION ALL SELECT 'union', count(DISTINCT otu) FROM members",
    "f21_sample_totals": "SELECT CASE WHEN model = 'sup' THEN concat(sample, '/', marker) ELSE sample END AS view_key, count(*) AS n FROM reads GROUP BY 1",
    "f23_path_weights": "SELECT family, genus, weight FROM (SELECT family, genus, count(DISTINCT hash) AS weight, row_number() OVER (PARTITION BY family ORDER BY count(DISTINCT hash) DESC, genus) AS nth FROM hits GROUP BY family, genus) AS x WHERE nth <= 3",
    "f25_rank_rows_with_zeros": "SELECT d.marker, d.model, coalesce(x.n, 0) AS n FROM (SELECT a.marker, b.model FROM (SELECT DISTINCT marker FROM reads) a CROSS JOIN (SELECT DISTINCT model FROM reads) b) d LEFT JOIN (SELECT marker, model, count(*) AS n FROM reads GROUP BY marker, model) x ON d.marker = x.marker AND d.model = x.model",
    # ranking
    "g05_rolling_dedup": "SELECT seq_hash, doc_id, model FROM (SELECT md5(seq) AS seq_hash, doc_id, model, row_number() OVER (PARTITION BY md5(seq) ORDER BY CASE model WHEN 'sup' THEN 3 WHEN 'hac' THEN 2 ELSE 1 END DESC, doc_id) AS nth FROM reads) AS x WHERE nth = 1",
    "g08_best_id_per_member": "SELECT seq_hash, doc_id FROM (SELECT md5(seq) AS seq_hash, doc_id, row_number() OVER (PARTITION BY md5(seq) ORDER BY CASE model WHEN 'sup' THEN 4 WHEN 'hac2sup' THEN 3 WHEN 'hac' THEN 2 WHEN 'fast' THEN 1 ELSE 0 END DESC, read_id) AS nth FROM reads) AS x WHERE nth = 1",
    "g14_best_row_first_wins": "SELECT hash, subject, pident FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY pident DESC, ordinal, subject) AS nth FROM hsps) AS x WHERE nth = 1",
    "g16_representatives": "SELECT family, genus, species, hash FROM (SELECT *, row_number() OVER (PARTITION BY family, genus, species ORDER BY pident DESC, hash) AS nth, max(CASE WHEN species <> 'NA' THEN 1 ELSE 0 END) OVER (PARTITION BY family, genus) AS named FROM hits) AS x WHERE nth = 1 AND (species <> 'NA' OR named = 0)",
    "g20_best_foreign_neighbour": "SELECT hash, subject, pident FROM (SELECT h.hash, h.subject, h.pident, row_number() OVER (PARTITION BY h.hash ORDER BY h.pident DESC, h.length DESC, h.subject, h.ordinal) AS nth FROM hsps h JOIN lineage l ON h.subject = l.subject JOIN (SELECT b.hash, min(k.family) AS family FROM best b JOIN lineage k ON b.subject = k.subject GROUP BY b.hash) o ON h.hash = o.hash WHERE l.family <> o.family) AS x WHERE nth = 1",
    "g23_first_seen_snapshot": "SELECT otu, event_id, round FROM (SELECT otu, event_id, round, row_number() OVER (PARTITION BY otu ORDER BY round, event_id) AS nth FROM rounds) AS x WHERE nth = 1",
    # sets
    "i04_ever_seen": "SELECT otu FROM rounds WHERE round < 10 UNION SELECT otu FROM rounds WHERE round >= 10",
    "i05_barrier_without_exempt": "SELECT otu FROM members WHERE marker = 'R' UNION SELECT otu FROM members WHERE marker = 'A' EXCEPT SELECT s_suppkey FROM supplier WHERE s_nationkey = 1",
    "i08_active_candidates": "SELECT c.otu FROM (SELECT otu FROM sized WHERE n = 1 UNION SELECT otu FROM rounds WHERE marker = 'error') c WHERE NOT EXISTS (SELECT 1 FROM rounds r WHERE r.otu = c.otu AND r.marker = 'purchase')",
    "i11_rescue_first_header": "SELECT doc_id, min(origin) AS origin FROM (SELECT doc_id, 'pool' AS origin FROM reads WHERE qscore >= 15 UNION ALL SELECT doc_id, 'rescued' FROM labels WHERE quality = 1) AS x GROUP BY doc_id",
    # rounds and caches
    "l12_failed_rounds": "SELECT round, count(*) AS n, count(CASE WHEN marker = 'error' THEN 1 END) AS errors, count(CASE WHEN marker = 'error' THEN 1 END) * 5 > count(*) AS failed FROM rounds GROUP BY round",
    "l14_prune_with_recovery": "SELECT DISTINCT otu, read_id FROM members WHERE marker = 'R' EXCEPT SELECT m.otu, m.read_id FROM members m JOIN supplier s ON m.otu = s.s_suppkey WHERE s.s_acctbal > 5000",
    "m01_cache_misses": "SELECT DISTINCT w.seq_hash FROM (SELECT md5(seq) AS seq_hash FROM reads) w LEFT JOIN (SELECT DISTINCT md5(seq) AS seq_hash FROM reads WHERE model = 'sup') c ON w.seq_hash = c.seq_hash WHERE c.seq_hash IS NULL",
    # reports and integrity
    "n03_otu_fate": "SELECT fate, count(*) AS n FROM (SELECT u.otu, CASE WHEN s.s_acctbal > 5000 THEN 'consolidated' WHEN s.s_acctbal < 0 THEN 'frozen' ELSE 'open' END AS fate FROM (SELECT DISTINCT otu FROM members) u LEFT JOIN supplier s ON u.otu = s.s_suppkey) AS x GROUP BY fate",
    "n07_taxa_over_time": "SELECT round, 'marker' AS rank_name, marker AS taxon, count(*) AS n FROM rounds GROUP BY round, marker UNION ALL SELECT DISTINCT CAST(0 AS BIGINT), 'marker', marker, CAST(0 AS BIGINT) FROM rounds",
    "o02_pair_set_equality": "SELECT coalesce(a.otu, b.otu) AS otu, coalesce(a.read_id, b.read_id) AS read_id, CASE WHEN a.otu IS NULL THEN 'extra' ELSE 'missing' END AS problem FROM (SELECT DISTINCT otu, read_id FROM members WHERE marker <> 'R') a FULL OUTER JOIN (SELECT DISTINCT otu, read_id FROM members WHERE marker <> 'A') b ON a.otu = b.otu AND a.read_id = b.read_id WHERE a.otu IS NULL OR b.otu IS NULL",
    "o04_conflicting_duplicate": "SELECT hash, subject, count(DISTINCT pident) AS variants FROM hsps GROUP BY hash, subject HAVING count(DISTINCT pident) > 1",
    "o05_counts_reconcile": "SELECT a.marker, a.n AS total, b.n AS summed, a.n = b.n AS sound FROM (SELECT marker, count(*) AS n FROM rounds GROUP BY marker) a JOIN (SELECT marker, CAST(sum(n) AS BIGINT) AS n FROM sized GROUP BY marker) b ON a.marker = b.marker",
}
