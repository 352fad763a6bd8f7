"""Orders of rounds, runs and reported rows, and numbering by an order without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.functions.labels import natural_round_key
from tidewater.workspace import Workspace, tasks_for

_STAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def instant(text: Column) -> Column:
    """The moment that an ISO text names, in UTC where it names no zone; null for any other text."""
    zoned = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(_STAMP), zoned.try_cast("timestamp"))


def round_order(label: Column, stamp: Column, barcode: Column) -> list[Column]:
    """Rounds by the natural key of their label; those without a label after them by time; then those with neither."""
    named, key, at = F.coalesce(F.length(label) > 0, F.lit(False)), natural_round_key(label), instant(stamp)
    own = F.coalesce(barcode, F.lit(""))
    return [F.when(named, 0).when(at.isNotNull(), 1).otherwise(2).asc(), F.when(named, key).asc(), F.when(~named, at).asc(), own.asc()]


def by_index(rounds: DataFrame, index: DataFrame, label: str = "round_barcode") -> DataFrame:
    """rounds with the place that the authoritative index (label, place) gives them; a round absent from it raises an error on reading."""
    known = rounds.join(index.select(label, F.col("place").alias("_place")), label, "left")
    lost = F.raise_error(F.concat(F.lit("round absent from the index: "), F.coalesce(label, F.lit("null")))).cast("long")
    return known.withColumn("place", F.coalesce(F.col("_place").cast("long"), lost)).drop("_place")


def run_order(updated: Column, last_round: Column, run_id: Column) -> list[Column]:
    """Runs by their last update, the latest first; runs without a valid one last; then by id."""
    at = instant(F.coalesce(F.when(updated != "", updated), last_round))
    return [at.isNull().asc(), at.desc(), F.coalesce(run_id, F.lit("")).asc()]


def reported_order(marker: Column, shown: Column, member: Column) -> list[Column]:
    """Reported rows by marker, the number of a key OTUB_<number> (other keys: 0) and member."""
    number = F.regexp_extract(shown, r"^OTUB_([0-9]+)", 1)
    return [marker.asc(), F.coalesce(F.when(number != "", number.cast("decimal(38,0)")), F.lit(0)).asc(), member.asc()]


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """df with the place of each row, from 1, by a total order.

    Rows are dealt by ranges of the order and written; each range is numbered by itself and
    raised by the count of those before, so that only one row a range meets in one task.
    """
    space = Workspace(df.sparkSession, "numbered")
    dealt, _ = space.table(df.repartitionByRange(tasks_for(df), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    bases = dealt.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    own = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(bases, "_range").withColumn(name, F.col("_base") + F.col("_own")).drop("_range", "_base", "_own")


def read_counts(summary: DataFrame, sample: str | None = None) -> DataFrame:
    """Reads per sample, replicate and barcode of a demultiplexing summary: hac rows whose sample is no no_adapter class.

    Samples and replicates are those of the track columns where any row has a track_sample_label, else the plain ones; null is empty.
    """
    text = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    tracked = "track_sample_label" in summary.columns and summary.where(text("track_sample_label") != "").limit(1).count() > 0
    names = ("track_sample_label", "track_replicate_suffix") if tracked else ("sample_name", "replicate")
    rows = summary.select(text(names[0]).alias("sample"), text(names[1]).alias("replicate"), "barcode", "basecalling_model", "read_count")
    rows = rows.where(~F.col("sample").startswith("no_adapter") & (F.col("basecalling_model") == "hac"))
    if sample:
        rows = rows.where(F.col("sample") == sample)
    return rows.groupBy("sample", "replicate", "barcode").agg(F.sum("read_count").cast("long").alias("reads"))
