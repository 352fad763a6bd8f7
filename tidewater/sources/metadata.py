"""The sample sheet: a headered table of which a run's rows are selected and checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns that a sheet must have.
MANDATORY = ["Sample_ID", "Pipeline_ID", "Replicate", "Well", "Plate", "Run", "demult_id"]


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a tab-separated sheet as text, with the number of the line; a missing mandatory column raises an error. A sheet has a row a sample and is read as one part."""
    lines = spark.read.text(path)
    head = lines.first()
    names = head[0].rstrip("\r").split("\t") if head else []
    if missing := [x for x in MANDATORY if x not in names]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    at = {x: k for k, x in enumerate(names)}  # of columns with one name the last counts
    sheet = lines.coalesce(1).select(F.monotonically_increasing_id().alias("line"), F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f"))
    cells = [F.coalesce(F.get("f", F.lit(k)), F.lit("")).alias(x) for x, k in at.items()]
    return sheet.where("line > 0").select((F.col("line") + 1).alias("line"), *cells)


def problems() -> Column:
    """What is wrong with a row of the mandatory columns, in a fixed order between semicolons; empty where nothing is. Null counts as empty."""
    text = {x: F.coalesce(F.col(x), F.lit("")) for x in MANDATORY}
    found = [F.when(text[x] == "", f"{x} is empty") for x in MANDATORY]
    found += [F.when(text[x].rlike(r"[\s_]"), f"{x} must not contain whitespace or _") for x in ("Replicate", "Well", "Plate")]
    for x in ("Sample_ID", "Pipeline_ID"):
        found.append(F.when(text[x].rlike(r"\s"), f"{x} must not contain whitespace"))
        found += [F.when(text[x].contains(mark), f"{x} must not contain {mark}") for mark in "|/"]
        found.append(F.when(F.lower(text[x]).rlike("^no_adapter(_[0-9]+)?$"), f"{x} must not use reserved no_adapter identity"))
    found += [F.when(text[x].rlike(r"\s"), f"{x} must not contain whitespace") for x in ("Run", "demult_id")]
    wanted = F.concat(F.lit(">"), text["Well"], F.lit("_"), text["Plate"])
    found.append(F.when((text["demult_id"] != "") & (text["demult_id"] != wanted), F.concat(F.lit("demult_id must equal "), wanted)))
    return F.concat_ws("; ", *found)


def select_run(sheet: DataFrame, run: str, strict: bool = True) -> DataFrame:
    """The run's rows with well_plate, unit and problems; a row with a problem raises an error where strict. Rows of other runs are not checked."""
    found = problems()
    if strict:
        found = F.when(found != "", F.raise_error(F.concat(F.lit("sample sheet: "), found))).otherwise(found)
    place = F.concat_ws("_", F.coalesce("Well", F.lit("")), F.coalesce("Plate", F.lit("")))
    rows = sheet.where(F.col("Run") == run).withColumn("problems", found)
    return rows.withColumn("well_plate", place).withColumn("unit", F.concat_ws("_", F.coalesce("Replicate", F.lit("")), place))
