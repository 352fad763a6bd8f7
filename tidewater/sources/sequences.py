"""Text formats of sequencing tools as DataFrames, by Spark's text reader: splittable where the format is, on any file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HSP_SCHEMA = (
    "hash string, subject string, taxid long, evalue string, length int, pident double, bitscore string, qstart int, qend int, sstart int, send int, qlen int"
)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id and seq of each record; the id ends at white space, sequence lines are joined, records without either are left out."""
    # a record begins at a line's start only; the first of a file keeps its mark
    rows = spark.read.option("lineSep", "\n>").text(path).withColumn("value", F.regexp_replace("value", r"^\s*>", "")).where("value rlike '[^ \\\\s]'")
    head = F.regexp_extract("value", r"^([^\n]*)", 1)
    out = rows.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"\s", "").alias("seq"))
    return out.where("id <> '' and seq <> ''")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, place of the line in its file, and value; lines are counted a block of a file at a time, so that files are split."""
    block = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = spark.read.text(path).select(*block, "value", F.monotonically_increasing_id().alias("nth"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = lines.groupBy("file", "block").count().select("file", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = F.row_number().over(W.partitionBy("file", "block").orderBy("nth"))
    return lines.withColumn("own", own).join(bases, ["file", "block"]).select("file", (F.col("base") + F.col("own") - 1).alias("place"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, header, seq and qual of four-line records; a cut record raises an error."""
    lines = _numbered(spark, path).withColumn("record", F.floor(F.col("place") / 4))
    filled = lines.groupBy("file", "record").agg(*[F.max(F.when(F.col("place") % 4 == k, F.col("value"))).alias(n) for k, n in enumerate(("head", "seq", "plus", "qual"))])
    blank = (F.coalesce("head", F.lit("")) == "") & F.col("seq").isNull()
    sound = F.col("head").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual"))
    checked = filled.withColumn("ok", F.when(blank, False).when(sound, True).otherwise(F.raise_error(F.concat(F.lit("broken FASTQ record in "), "file")).cast("boolean")))
    return checked.where("ok").select(F.regexp_extract("head", r"^@(\S*)", 1).alias("id"), F.expr("substring(head, 2)").alias("header"), "seq", "qual")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """cluster, member and is_rep of a .clstr file; a cluster's lines are read as one record, so that files are split between clusters."""
    rows = spark.read.option("lineSep", "\n>Cluster ").text(path).withColumn("value", F.regexp_replace("value", r"^\s*>Cluster ", ""))
    lines = rows.select(F.regexp_extract("value", r"^(\d+)", 1).alias("cluster"), F.explode(F.split("value", r"\r?\n")).alias("line"))
    members = lines.where("cluster <> '' and instr(line, '>') > 0")
    return members.select(F.col("cluster").cast("long").alias("cluster"), F.regexp_extract("line", r">(.+?)\.\.\.", 1).alias("member"), F.col("line").endswith("*").alias("is_rep"))


def read_hsps(spark: SparkSession, path: str) -> DataFrame:
    """Twelve-column alignment rows, typed; a malformed row raises an error. Exact decimals stay text."""
    return spark.read.schema(HSP_SCHEMA).option("sep", "\t").option("comment", "#").option("mode", "FAILFAST").csv(path)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """read_id, flag, ref, seq and parent (tag pi:Z) of alignment lines with at least eleven fields."""
    rows = spark.read.text(path).where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 11)
    parent = F.get(F.filter("f", lambda x: x.startswith("pi:Z:")), F.lit(0))
    return rows.select(F.col("f")[0].alias("read_id"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("ref"), F.col("f")[9].alias("seq"), F.substring(parent, 6, 1 << 20).alias("parent"))


def read_table(spark: SparkSession, path: str, required: list[str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """A headered tab-separated table; the first alias found names a column, and a missing required one raises an error."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    for name, others in (aliases or {}).items():
        found = next((x for x in [name, *others] if x in df.columns), None)
        if found and found != name:
            df = df.withColumnRenamed(found, name)
    if missing := [x for x in required if x not in df.columns]:
        raise ValueError(f"{path} lacks {missing}")
    repeated = [F.col(x) == x for x in df.columns[:2]]
    return df.where(~F.coalesce(repeated[0] & repeated[-1], F.lit(False)))
