import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import ranking, rounds, taxonomy
from tidewater.operators.graph import connected_components
from tidewater.sources import sequences, sinks
from tidewater.streaming import rounds as streaming


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 120)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())) == want
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("hub", [0, 5000])
def test_components_of_hot_nodes(spark, hub):
    edges = [(hub, k) for k in range(1, 900)] + [(k, 2000 + k) for k in range(1, 50)] + [(7000, 7001)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    nodes = {x for e in edges for x in e}
    assert got == {x: 7000 if x >= 7000 else min(hub, 1) for x in nodes}


def test_best_with_ties_keeps_all_equal(spark):
    rows = [(1, "a", 5, 1, 9, 90, 1), (1, "b", 5, 1, 9, 90, 2), (1, "a", 4, 0, 9, 99, 3), (2, "c", 1, 1, 1, 80, 1)]
    df = spark.createDataFrame(rows, "hash long, subject string, bitscore long, evalue long, length long, pident long, ordinal long")
    assert sorted((x.hash, x.subject) for x in ranking.best_hsps(df).collect()) == [(1, "a"), (1, "b"), (2, "c")]


def test_lca_and_vote(spark):
    rows = [(1, "F", "G", "S1"), (1, "F", "G", "S2"), (2, "F", None, "S"), (2, "F", "G", "S"), (3, "F", "G", "S"), (4, "A", "G", "S"), (4, "B", "G", "S")]
    df = spark.createDataFrame(rows, "k long, family string, genus string, species string")
    got = {x.k: (x.family, x.genus, x.species, x.depth, x.status) for x in taxonomy.common_lineage(df, ["k"], ["family", "genus", "species"]).collect()}
    assert got[1] == ("F", "G", None, 1, "AMBIGUOUS_TIE")
    assert got[2] == ("F", None, "S", 2, "AMBIGUOUS_TIE")
    assert got[3] == ("F", "G", "S", 2, "ASSIGNED")
    assert got[4] == (None, None, None, -1, "REFERENCE_UNRESOLVED")
    same = spark.createDataFrame([(9, "F", "G", "S", -1), (9, "F", "G", "S", -1), (8, "F", "G", "S", -1), (8, "F", "G", "S", -2)], "k long, family string, genus string, species string, taxid long")
    got = {x.k: x.status for x in taxonomy.common_lineage(same, ["k"], ["family", "genus", "species"], ["taxid", "family", "genus", "species"]).collect()}
    assert got == {9: "ASSIGNED", 8: "AMBIGUOUS_TIE"}
    votes = {x.k: (x.species, x.genus, x.status, x.votes, x.winners) for x in taxonomy.plurality(df, ["k"], ["family", "genus", "species"]).collect()}
    assert votes[1] == (None, "G", "AMBIGUOUS_TIE", 1, 2) and votes[2] == ("S", None, "AMBIGUOUS_TIE", 1, 2) and votes[3] == ("S", "G", "ASSIGNED", 1, 1)
    won = taxonomy.plurality(df.union(df.where("species = 'S1'")), ["k"], ["family", "genus", "species"]).where("k = 1").first()
    assert (won.species, won.status, won.votes) == ("S1", "ASSIGNED", 2)


def test_streak_resets_by_absence(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("x", 4), ("x", 5), ("x", 6)], "k string, round long")
    assert [x.streak for x in rounds.streaks(df, ["k"]).orderBy("round").collect()] == [1, 2, 1, 2, 3]


def test_promotion_needs_steady_counts(spark):
    rows = [("a", 1, 20), ("a", 2, 20), ("a", 3, 20), ("b", 1, 40), ("b", 2, 40), ("b", 3, 10), ("c", 1, 100)]
    got = {x.k: x.promoted for x in rounds.promotions(spark.createDataFrame(rows, "k string, round long, n long"), ["k"], "n").collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_scalars(spark):
    df = spark.createDataFrame([(">r1|COI|HAC_fixed|barcode=b1|adapter=no_adapter_2 x", "1e-400", "2e-399")], "h string, e string, f string")
    row = df.select(
        S.base_read_id("h").alias("a"), S.header_model("h").alias("b"), S.keyed_token("h", "barcode").alias("c"),
        (S.decimal_key("e") < S.decimal_key("f")).alias("d"), S.reverse_complement(F.lit("AACG")).alias("r"), S.round_number(F.lit("run3_b12x")).alias("n"),
        S.hit_taxid(F.lit("x|kraken:taxid|-7")).alias("t"), S.replicate_label(F.lit("ad_3")).alias("l"),
    ).first()
    assert tuple(row) == ("r1", "hac", "b1", True, "CGTT", 12, -7, "rep_3")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">r1 a>b\nACG\nT\n>empty\n\n>r2\nGG\n")
    assert sorted(map(tuple, sequences.read_fasta(spark, str(tmp_path / "a.fasta")).collect())) == [("r1", "ACGT"), ("r2", "GG")]
    (tmp_path / "a.fastq").write_text("@q1 x\nAC\n+\nII\n@q2\nG\n+\nI\n")
    assert sorted((x.id, x.seq) for x in sequences.read_fastq(spark, str(tmp_path / "a.fastq")).collect()) == [("q1", "AC"), ("q2", "G")]
    (tmp_path / "a.clstr").write_text(">Cluster 0\n0\t10nt, >m1... *\n1\t9nt, >m2... at 98%\n>Cluster 1\n0\t9nt, >m3... *\n")
    assert sorted(map(tuple, sequences.read_clusters(spark, str(tmp_path / "a.clstr")).collect())) == [(0, "m1", True), (0, "m2", False), (1, "m3", True)]
    out = str(tmp_path / "rounds")
    for rows in ([(1, "a"), (2, "b")], [(2, "c")], [(2, "c")]):
        sinks.write_round(spark.createDataFrame(rows, "round int, v string"), out)
    assert sorted((x.round, x.v) for x in spark.read.parquet(out).collect()) == [(1, "a"), (2, "c")]


def test_stream_equals_batch(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(k, "x"), (10 + k, "y")], "id int, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = streaming.watch(spark, str(tmp_path / "in"), "id int, v string")
    streaming.run_rounds(stream, out, str(tmp_path / "state"))
    got = spark.read.parquet(out)
    assert got.select("round").distinct().count() == 3
    assert sorted(x.id for x in got.collect()) == [0, 1, 2, 10, 11, 12]
