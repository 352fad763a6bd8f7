"""Small text tables beside the reads: batches of files, ledgers of those already done, two-column and key tables, lines of JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_scan(spark: SparkSession, pattern: str, reader: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """reader's rows of the files that pattern names; a pattern without any file raises an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if found is None or not len(found):
        raise FileNotFoundError(f"no file matches {pattern}")
    return reader(spark, pattern)


def skip_done(files: DataFrame, ledger: DataFrame, done_root: str | None = None) -> DataFrame:
    """Distinct rows of files (path, and whatever else) that the ledger (value, a line each) does not hold.

    A line holds a path, or path, size, mtime and perhaps inode between tabs; a line's path alone says that a file
    is done. Directly below done_root a file is also done where a line is its bare name. Blank lines hold nothing.
    Each key is an equi-join, so that neither side is broadcast unless the optimizer finds it small.
    """
    lines = ledger.select(F.trim(F.split("value", "\t")[0]).alias("_done")).where("_done <> ''").distinct()
    left = files.distinct().join(lines, F.col("path") == F.col("_done"), "left_anti")
    if done_root is None:
        return left
    name = F.when(F.regexp_extract("path", r"^(.*)/[^/]*$", 1) == done_root.rstrip("/"), F.substring_index("path", "/", -1))
    return left.withColumn("_name", name).join(lines, F.col("_name") == F.col("_done"), "left_anti").drop("_name")


def two_columns(spark: SparkSession, path: str, key: str, value: str) -> tuple[str, DataFrame]:
    """(status, rows of key and value) of one tab-separated file whose header is optional.

    The status is missing, unreadable, empty, invalid (a line without two columns where no header names them) or ok;
    all but ok come with no row. Under a header, lines too short for either column are left out.
    """
    none = spark.createDataFrame([], f"`{key}` string, `{value}` string")
    if not path.strip():
        return "missing", none
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return "missing", none
    try:
        first = spark.read.text(path).first()
    except Exception as error:  # the status says so; a caller that needs the rows fails on it
        if "denied" in str(error).lower():
            return "unreadable", none
        raise
    if first is None:
        return "empty", none
    head = [x.strip().lower() for x in first[0].split("\t")]
    named = key.lower() in head and value.lower() in head
    at = [len(head) - 1 - head[::-1].index(x.lower()) for x in (key, value)] if named else [0, 1]
    lines = spark.read.text(path).select("value", (F.col("_metadata.file_block_start") + F.monotonically_increasing_id()).alias("place"))
    if named:  # the header is the first line of the file, in the first task
        lines = lines.where("place <> 0")
    cells = lines.where("value rlike '[^ \\\\s]'").select(F.split("value", "\t").alias("f"))
    wide = F.size("f") > max(at)
    if not named and cells.where(~wide).limit(1).count():
        return "invalid", none
    rows = cells.where(wide).select(F.col("f")[at[0]].alias(key), F.col("f")[at[1]].alias(value))
    return ("ok", rows) if rows.limit(1).count() else ("empty", none)


def key_values(lines: DataFrame, required: list[str] = ()) -> dict[str, str]:
    """The first value of each required key among lines (place, value) of key and value between tabs; one that is absent or empty raises an error."""
    parts = lines.select("place", F.split("value", "\t").alias("f")).select("place", F.col("f")[0].alias("key"), F.get("f", F.lit(1)).alias("held"))
    first = parts.where(F.col("key").isin(list(required))).groupBy("key").agg(F.min_by("held", "place").alias("held"))
    found = {x.key: x.held for x in first.collect()}  # a row per required key at most
    if missing := [x for x in required if not found.get(x)]:
        raise ValueError(f"required keys without a value: {missing}")
    return found


def json_lines(lines: DataFrame, schema: str) -> DataFrame:
    """lines (value, and whatever else) that are not blank, with record (a struct of schema, null unless the line is one JSON object)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    held = lines.where("value rlike '[^ \\\\s]'").withColumn("record", F.from_json("value", f"{schema}, _broken string", options))
    sound = F.col("record._broken").isNull() & F.trim("value").startswith("{")
    return held.withColumn("record", F.when(sound, F.col("record").dropFields("_broken")))


def append_history(lines: DataFrame, added: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of a history after added (value) is appended: of old lines, those of the same keys go, malformed ones stay as they are.

    A key that a record lacks counts as the empty text. Blank lines go.
    """
    schema = ", ".join(f"`{x}` string" for x in keys)

    def keyed(df: DataFrame) -> DataFrame:
        held = json_lines(df.select("value"), schema)
        return held.select("value", F.when(F.col("record").isNotNull(), F.struct(*[F.coalesce(f"record.{x}", F.lit("")).alias(x) for x in keys])).alias("_key"))

    old, new = keyed(lines), keyed(added)
    stay = old.join(new.select("_key").distinct(), "_key", "left_anti")  # a null key matches nothing
    return stay.select("value").union(new.select("value"))
