"""State steps and fail-closed joins by literal cases."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import states as T
from tidewater.operators import strict as X


def _df(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def _set(df):
    return {tuple(x) for x in df.collect()}


def test_unassigned_streak(spark):
    members = _df(spark, "otu string, uuid string, ordinal long, key string", ("a", "r1", 1, None), ("a", "r2", 2, "K1"), ("a", "r3", 3, "K9"), ("b", "r4", 1, "K2"), ("b", "r5", 2, "K2"), ("c", "r6", 1, "K3"), ("d", "r7", 1, None), ("d", "r8", 2, None))
    assigned, state = _df(spark, "otu string", ("b",)), _df(spark, "key string, streak long", ("K1", 2), ("K2", 5), ("K7", 1))
    after, prune = T.unassigned_streak(members, assigned, state, 2, 3, 3)
    assert _set(after) == {("K1", 3, True)} and _set(prune) == {("r1",), ("r2",), ("r3",)}
    after, prune = T.unassigned_streak(members, assigned, after.select("key", "streak"), 1, 1, 3)
    assert _set(after) == {("K3", 1, False)} and prune.count() == 0


def test_size_streak(spark):
    sizes = _df(spark, "key string, size long", ("a", 1), ("b", 1), ("c", 4), ("d", 1), ("d", 2))
    after = T.size_streak(sizes, _df(spark, "key string", ("b",)), _df(spark, "key string, streak long", ("a", 1), ("d", 1)), 2, 2)
    assert _set(after) == {("a", 2, True)}


def test_lock_rules_and_steps(spark):
    schema = "otu string, hash string, qscore double, n long, ordinal long"
    clusters = _df(spark, schema, ("a", "h1", 20.0, 100, 1), ("a", "h2", 20.0, 10, 2), ("a", "h3", None, 9, 3), ("b", "h1", 20.0, 60, 1), ("b", "h2", 20.0, 55, 2), ("c", "h1", 5.0, 99, 1))
    run = lambda mode, **k: {x.otu: (x.passes, x.significant) for x in T.lock_rule(clusters, mode, 15, 50, **k).collect()}
    assert run("ratio", ratio=0.1) == {"a": (True, 1), "b": (True, 2), "c": (False, 0)}
    assert run("ratio", ratio=0.05)["a"] == (False, 1)
    assert run("share", pool_share=0.5, top_share=0.5) == {"a": (True, 1), "b": (True, 1), "c": (False, 0)}
    assert run("share", pool_share=0.4, top_share=0.95)["b"] == (True, 1)
    assert run("gap", gap_ratio=2.0, gap_reads=20) == {"a": (True, 1), "b": (False, 0), "c": (False, 0)}
    with pytest.raises(ValueError):
        run("other")
    rule, frozen = T.lock_rule(clusters, "ratio", 15, 50, ratio=0.1), _df(spark, "otu string", ("a",), ("c",))
    state = _df(spark, "otu string, passes boolean, stable int, consolidated boolean", ("c", True, 4, True))
    for step in range(1, 4):
        state = spark.createDataFrame(T.lock_step(rule, frozen, state, 3).collect(), state.schema)
        assert _set(state) == {("a", True, step, step >= 3), ("b", False, 0, False), ("c", False, 0, True)}


def test_policies(spark):
    assert T.prune_policy("always", 10, 5, False, True) == "until_consolidated" and T.prune_policy("always", 10, 5, False, False) == "always"
    assert T.prune_policy("never", 10, 5, False, True) == "never" and T.prune_policy("never", 10, 5, True, True) == "until_consolidated"
    assert T.prune_policy("always", 10, 0, True, True) == "always"
    frozen, pool, keys = _df(spark, "header string", ("r1|x",), ("r1|y",)), _df(spark, "read_id string, sample string, otu string", ("r1", "s", "o"), ("r2", "t", "o"), ("r3", "s", "p")), _df(spark, "sample string, otu string", ("s", "o"))
    ids = lambda policy, by: {x.read_id for x in T.frozen_prune_ids(policy, frozen, pool, keys, by).collect()}
    assert (ids("always", True), ids("never", True), ids("until_consolidated", True), ids("until_consolidated", False)) == ({"r1"}, set(), {"r1"}, {"r1", "r2"})
    rows = _df(spark, "mode string, i long", ("off", 9), ("observe", 2), ("observe", 3), ("apply", 3))
    assert [r[0] for r in rows.select(T.unassigned_prune_status(F.col("mode"), F.col("i"), 2)).collect()] == ["mode_off", "grace", "observe", "applied"]


def test_pools_snapshots_fates(spark):
    old, new = _df(spark, "header string, ordinal long", ("r1|C|hac", 1), ("r2|C|sup", 2)), _df(spark, "header string, ordinal long", ("r1|C|sup", 1), ("r2|D|sup", 2), ("r3|C|fast", 3))
    pool = T.rolling_pool(old, new)
    assert {x.header for x in pool.collect()} == {"r1|C|sup", "r2|C|sup", "r3|C|fast"}
    same, mark = T.unchanged(pool, ["read_id", "header"], None)
    assert not same and T.unchanged(pool.orderBy(F.desc("header")), ["read_id", "header"], mark)[0] and not T.unchanged(pool.limit(2), ["read_id", "header"], mark)[0]
    members, promoted = _df(spark, "otu string, uuid string, stable_key string", ("a", "r1", "K"), ("a", "r2", None), ("b", "r3", "Z")), _df(spark, "otu string", ("a",))
    assert _set(T.frozen_snapshot(promoted, members, "mixed")) == {("K", "r1"), ("a", "r2")} and _set(T.frozen_snapshot(promoted, members, "legacy")) == {("a", "r1"), ("a", "r2")}
    with pytest.raises(ValueError):
        T.frozen_snapshot(promoted, members, "strict")
    active = _df(spark, "otu string, seen boolean, assigned boolean, size_due boolean", ("a", True, False, True), ("b", True, True, True), ("c", False, False, False), ("d", None, None, True))
    assert dict(_set(T.fate_of_otus(active, False, True, False))) == {"a": "blast_unassigned", "b": "size_streak", "c": "informative_dynamic", "d": "size_streak"}
    assert dict(_set(T.fate_of_otus(active, True, True, True))) == {"a": "prune_candidates", "b": "prune_candidates", "c": "informative_dynamic", "d": "prune_candidates"}


def test_admission_and_ids(spark):
    rows = _df(spark, "otu string, marker string, kingdom string, adapter string", ("a", "COI", "metazoa", "x"), ("b", "COI", "Unassigned", "x"), ("c", "COI", "Unassigned", "no_adapter"), ("a", "COI", "Unassigned", "x"), ("d", "Z", "Unassigned", "x"))
    pairs = _df(spark, "marker string, kingdom string", ("COI", "Metazoa"))
    got = T.admitted(rows, pairs, True)
    assert sorted((x.otu, x.admission) for x in got.collect()) == [("a", "compatible"), ("a", "unassigned"), ("b", "unassigned")]
    assert _set(T.admitted_unassigned_otus(got)) == {("b",)} and T.admitted(rows, pairs, False).count() == 1
    heads = _df(spark, "header string", ("u1|C|hac|barcode=b|adapter=a",), ("u1|C|sup|barcode=b|adapter=a",), ("u2|C|fast|barcode=b|adapter=a",), ("u2|C|fast|barcode=a|adapter=a",), ("u3|D|x",))
    asked = _df(spark, "id string", ("u1|C|hac|barcode=b|adapter=a extra",), ("u1|C|fast|barcode=b|adapter=a|OTUB_1-C",), ("u2|C",), ("u3|other",), ("u9",))
    assert dict(_set(T.resolve_ids(asked, heads))) == {"u1|C|hac|barcode=b|adapter=a": "u1|C|hac|barcode=b|adapter=a", "u1|C|fast|barcode=b|adapter=a": "u1|C|sup|barcode=b|adapter=a", "u2|C": "u2|C|fast|barcode=a|adapter=a", "u3|other": "u3|D|x"}
    provenance, held = _df(spark, "consensus_id string, otu_key string", ("c1", "o1"), ("c2", "o2"), ("c3", "NA")), _df(spark, "consensus_id string, display_otu_key string, stable_otu_key string", ("c1", "o1", "K"), ("c2", "o2", "NA"))
    assert _set(T.assigned_otu_keys(provenance, held)) == {("o1",)}
    with pytest.raises(ValueError):
        T.assigned_otu_keys(provenance, held.withColumn("display_otu_key", F.lit("zz")))
    reads = _df(spark, "header string", ("r|C|hac|adapter=no_adapter_1",), ("r|C|hac|adapter=ad_2",), ("r",))
    assert tuple(T.no_adapter_policy(reads).first()) == (True, True, True) and tuple(T.no_adapter_policy(reads.limit(0)).first()) == (False, False, False)


def test_consensus_tiers_adjudication_baseline(spark):
    entries = _df(spark, "k string, header string, reads long, ordinal long", ("a", "h1", 5, 1), ("a", "h2", 9, 2), ("a", "h3", 9, 3))
    assert (T.best_consensus(entries, ["k"]).first().header, T.best_consensus(entries, ["k"], "h1").first().header, T.best_consensus(entries, ["k"]).first().total_reads) == ("h2", "h1", 23)
    hits = _df(spark, "query string, reference string, pident double, coverage double, bitscore double", ("q", "r1", 90.0, 99.0, 500.0), ("q", "r2", 99.0, 99.0, 100.0), ("q", "r3", 99.0, 99.0, 100.0))
    assert [(x.reference, x.discovery_tier) for x in T.candidate_tiers(hits, 97, 80).orderBy("place").collect()] == [("r2", "priority"), ("r3", "priority"), ("r1", "review")]
    refs, edges = _df(spark, "reference string, family string", ("a", "F"), ("b", "G"), ("c", "G"), ("d", "")), _df(spark, "a string, b string, pident double, coverage double", ("a", "b", 96.0, 80.0), ("c", "a", 97.0, 70.0), ("b", "c", 99.0, 99.0), ("a", "d", 99.0, 99.0))
    got = {x.reference: (x.neighbour, x.disposition.split("_")[0]) for x in T.adjudications(refs, edges).collect()}
    assert got == {"a": ("c", "cross"), "b": ("a", "cross"), "c": ("a", "cross"), "d": (None, "unresolved")}
    base, now = _df(spark, "k string, n long", ("a", 0), ("b", 0)), _df(spark, "k string, n long", ("a", 7))
    assert _set(T.with_baseline(now, base, ["k"])) == {("a", 7), ("b", 0)} and T.consolidate_unassigned(now, now).count() == 1


def test_fail_closed_joins(spark):
    left, right = _df(spark, "k string, a long", ("x", 1), ("y", 2)), _df(spark, "k string, b long", ("x", 1), ("y", 2))
    assert X.strict_join(left, right, ["k"]).count() == 2
    for a, b in ((left.limit(1), right), (left, right.limit(1)), (left.union(left), right), (left, right.union(right))):
        with pytest.raises(ValueError):
            X.strict_join(a, b, ["k"])
    refs, policy = _df(spark, "reference string", ("a",), ("b",)), _df(spark, "reference string, action string", ("a", "quarantine"))
    assert _set(X.dispositions(refs, policy)) == {("a", "quarantine"), ("b", "retain")}
    for bad in (policy.union(policy), _df(spark, "reference string, action string", ("zz", "retain")), _df(spark, "reference string, action string", ("a", "burn"))):
        with pytest.raises(ValueError):
            X.dispositions(refs, bad)
    audit, rules = _df(spark, "tier string, status string, r string", ("p", "s", "1")), _df(spark, "tier string, status string, action string", ("p", "s", "keep"))
    assert X.release_dispositions(audit, rules).first().action == "keep"
    with pytest.raises(ValueError):
        X.release_dispositions(audit, rules.where("tier = 'q'"))
    reads = _df(spark, "read_id string, marker string, parent string", ("p", "C", None), ("c", "C", "p"), ("q", "C", None))
    assert _set(X.split_parents(reads).select("read_id")) == {("c",), ("q",)}
    with pytest.raises(ValueError):
        X.split_parents(reads.union(_df(spark, "read_id string, marker string, parent string", ("c", "C", "q"))))
    meta, hashes = _df(spark, "hash string, rep string", ("h1", "r1")), _df(spark, "uuid string, hash string", ("r1", "h1"), ("r2", "h1"))
    assert X.frozen_representatives(meta, hashes).count() == 1
    with pytest.raises(ValueError):
        X.frozen_representatives(_df(spark, "hash string, rep string", ("h2", "r1")), hashes)
    members, ids = _df(spark, "read_id string, base_id string", ("r1/1", "r1"), ("r2/1", "r2")), _df(spark, "id string, base_id string, hash string", ("r1/1", "r1", "A"), ("r1/2", "r1", "B"), ("r2/9", "r2", "C"))
    assert {x.read_id: x.hash for x in X.base_id_map(members, ids, True).collect()} == {"r1/1": "A", "r2/1": "C"} and X.base_id_map(members, ids, False).where("hash is null").count() == 1
    with pytest.raises(ValueError):
        X.base_id_map(_df(spark, "read_id string, base_id string", ("r1/5", "r1")), ids, True)


def test_checks(spark):
    df = _df(spark, "t long, a long, b long", (3, 1, 2), (3, 1, 1), (None, 1, 1))
    assert X.conservation(df, "t", ["a", "b"]).count() == 1 and X.stage_order(df, ["t", "b", "a"]).count() == 0 and X.stage_order(df, ["a", "b"]).count() == 1
    key = lambda *x: _df(spark, "k string", *[(v,) for v in x])
    assert _set(X.not_a_partition(key("a", "b", "c", "d"), [key("a", "b"), key("b", "c", "z")], "k")) == {("b", 2), ("d", 0), ("z", 1)}
    assert _set(X.aggregate_mismatches(key("a", "a", "b"), _df(spark, "k string, n long", ("a", 2), ("b", 5), ("c", 0)), ["k"], "n").select("k")) == {("b",)}
    units = _df(spark, "unit string, marker string", ("u", "C"))
    assert X.marker_unit_mismatches(_df(spark, "unit string, marker string", ("u", "D"), ("u", "C"), ("v", "D")), units).count() == 1
    with pytest.raises(ValueError):
        X.marker_unit_mismatches(units, units.union(_df(spark, "unit string, marker string", ("u", "D"))))
