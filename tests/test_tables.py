"""Readers of small tables, split FASTQ and cluster files, and orders, by literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import scalars
from tidewater.operators import orders
from tidewater.sources import sequences, tables


def test_batch_scan(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">r\nAC\n")
    assert tables.batch_scan(spark, f"{tmp_path}/*.fasta", sequences.read_fasta).count() == 1
    with pytest.raises(FileNotFoundError):
        tables.batch_scan(spark, f"{tmp_path}/*.none", sequences.read_fasta)


def test_skip_done(spark):
    files = spark.createDataFrame([("/a/1", 5), ("/a/1", 5), ("/a/2", 5), ("/d/3", 1), ("/e/3", 1)], "path string, size long")
    ledger = spark.createDataFrame([("/a/2\t9\t9",), ("3",), ("",)], "value string")
    run = lambda *x: sorted(r.path for r in tables.skip_done(files, ledger, *x).collect())
    assert run() == ["/a/1", "/d/3", "/e/3"]
    assert run("/d/") == ["/a/1", "/e/3"]
    assert tables.skip_done(files.limit(0), ledger, "/d").count() == 0


@pytest.mark.parametrize(
    ("text", "status", "rows"),
    [(None, "missing", []), ("", "empty", []), ("K\tx\tV\n", "empty", []), ("one\n", "invalid", []), ("a\t1\nb\n", "invalid", []), ("a\t1\n\nb\t2\t3\n", "ok", [("a", "1"), ("b", "2")]), ("v \tx\tK\n1\t2\t3\n4\n", "ok", [("3", "1")])],
)
def test_two_columns(spark, tmp_path, text, status, rows):
    if text is not None:
        (tmp_path / "t.tsv").write_text(text)
    got, df = tables.two_columns(spark, str(tmp_path / "t.tsv"), "k", "v")
    assert got == status and sorted(map(tuple, df.collect())) == rows


def test_key_values(spark):
    lines = spark.createDataFrame([(1, "a\t1"), (0, "a\t0"), (2, "b"), (3, None)], "place long, value string")
    assert tables.key_values(lines, ["a"]) == {"a": "0"}
    for lost in ("b", "c"):
        with pytest.raises(ValueError):
            tables.key_values(lines, ["a", lost])


def test_history(spark):
    lines = ['{"run_id":"r","barcode":"b","x":1}', "{broken", "", '["run_id"]', '{"run_id":"r"}', None]
    old, new = (spark.createDataFrame([(x,) for x in v], "value string") for v in (lines, ['{"run_id":"r","barcode":"b","x":2}']))
    kept = [r.value for r in tables.append_history(old, new, ["run_id", "barcode"]).collect()]
    assert sorted(kept) == sorted([*lines[1:2], *lines[3:5], '{"run_id":"r","barcode":"b","x":2}'])
    assert [r.record is not None for r in tables.json_lines(old, "run_id string").collect()] == [True, False, False, True]


def test_split_files(spark, tmp_path):
    rng, reads, clusters = random.Random(5), [], []
    for k in range(3000):
        n = rng.randint(1, 40)
        reads.append((f"q{k}", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@+I>", k=n))))
        clusters += [(k, f"m{k}.{j}", j == 0) for j in range(rng.randint(1, 4))]
    (tmp_path / "a.fastq").write_text("".join(f"@{a} x\n{b}\n+\n{c}\n" for a, b, c in reads))
    (tmp_path / "a.clstr").write_text("".join((f">Cluster {k}\n" if rep else "") + f"0\t1nt, >{m}... {'*' if rep else 'at 98%'}\n" for k, m, rep in clusters))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert spark.read.text(str(tmp_path / "a.fastq")).rdd.getNumPartitions() > 4
        assert sorted((r.id, r.seq, r.qual) for r in sequences.read_fastq(spark, str(tmp_path / "a.fastq")).collect()) == sorted(reads)
        assert sorted(map(tuple, sequences.read_clusters(spark, str(tmp_path / "a.clstr")).collect())) == sorted(clusters)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_orders(spark):
    rounds = [("round2", None, "b"), ("round10", None, "a"), ("", "2024-01-02", "a"), (None, "2024-01-01T23:30:00-01:00", "a"), ("", "2024-01-01T23:00:00", "a"), ("", "soon", "a"), ("", None, "b")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rounds)], "k int, label string, stamp string, barcode string")
    assert [r.k for r in df.orderBy(*orders.round_order(F.col("label"), F.col("stamp"), F.col("barcode"))).collect()] == [0, 1, 4, 2, 3, 5, 6]
    index = spark.createDataFrame([("round2", 7)], "round_barcode string, place int")
    named = df.withColumnRenamed("label", "round_barcode")
    assert [r.place for r in orders.by_index(named.where("k = 0"), index).collect()] == [7]
    with pytest.raises(Exception, match="absent"):
        orders.by_index(named, index).collect()
    runs = spark.createDataFrame([("a", "never", "2024-05-01"), ("b", "", "2024-01-01"), ("c", "2024-03-01T00:00:00Z", None), ("d", None, None)], "run_id string, updated string, last string")
    assert [r.run_id for r in runs.orderBy(*orders.run_order(F.col("updated"), F.col("last"), F.col("run_id"))).collect()] == ["c", "b", "a", "d"]


def test_numbered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("x"))
    assert all(r.place == r.x + 1 for r in orders.numbered(df, [F.col("x").asc()]).collect())
    assert orders.numbered(df.limit(0), [F.col("x").asc()]).count() == 0


def test_adapter_class(spark):
    cases = {"a|adapter=NO_adapter_12 x": "no_adapter", "a|adapter=no_adapter": "no_adapter", "a|adapter=no_adapter_x": "with_adapter", "a|adapter=p|adapter=no_adapter": "with_adapter", "a": "with_adapter", "": "with_adapter"}
    got = spark.createDataFrame([(x,) for x in cases], "x string").select("x", scalars.adapter_class(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in got} == cases
