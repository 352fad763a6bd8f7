"""Near copies of whole texts: all pairs whose word-shingle sets have Jaccard similarity of at least ``likeness``.

Candidates come from SimHash: the fingerprints of the shingle sets are met by pigeonring
chains (tidewater.llm.simhash) within ``within`` bits, and the texts of each pair are
compared exactly. No radius with keys of use reaches every pair (sets at likeness 0.8
differ in some 10 of 64 bits, where a chain's key would have five), so what lies farther
apart has an exact way of its own: components that SimHash leaves apart are met by prefix
filtering. In any one order of all shingles, two sets that are so similar share a shingle
among the first n - ceil(likeness * n) + 1 of each, so an equi-join on these finds every
pair. The order is by hash, with shingles that are frequent in a sample last; that changes
the cost only. A pair must then agree in size, pass a bound (the parities of hash classes
differ in no more places than the sets: of SMALL * 64 classes within the join, of
PARITY or more after it) and the similarity itself.

Equal sets are one class with one row in the search; of the classes of one fingerprint the
least stands for all. Within the classes that share a shingle each is first compared with
the least one unless SimHash has linked them; the others only where their
components still differ, so that a large group of near copies costs one comparison
a member and shingle. Components are those of all pairs.

64-bit hashes stand for shingles and for sets. Defined cases: a text of
fewer words than a shingle is one shingle; null, empty and blank texts are one class;
an empty table gives an empty result; no column but doc_id and text is read for it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches, fresh
from tidewater.llm.simhash import hamming_pairs, majority
from tidewater.operators.graph import connected_components
from tidewater.workspace import Workspace

SEED, PARITY, KEY = 42, 1024, (1 << 40) - 1
#: One of SAMPLE texts counts for the order of shingles, in which those in over FREQUENT of them come last, at most MOST_FREQUENT.
SAMPLE, FREQUENT, MOST_FREQUENT = 32, 8, 100_000
ROW, SMALL = "_row", 8


def shingle_set(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """Distinct 64-bit hashes (as int64, ordered) of the word shingles of a UTF-8 text, A-Z in lower case."""
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(line, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        first, last = (ends - sizes)[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist()
        hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(first, last)]
    return np.unique(np.array(hashes, np.uint64).view(np.int64))


def least_shared(n: int, likeness: float) -> int:
    return math.ceil(likeness * n - 1e-9)


def similar(a: np.ndarray, b: np.ndarray, likeness: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= likeness * (len(a) + len(b) - both) - 1e-9


def _with_row(docs: DataFrame, name: str = ROW) -> DataFrame:
    """docs with a key of doc_id and text in the column name; rows that share one are copies of each other."""
    named = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return docs.withColumn(name, F.concat_ws("|", named, F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))))


def _frequent(texts: DataFrame, shingle: int) -> np.ndarray:
    def run(batches):
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), shingle))], ["key"])

    part = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "key long")
    counts = part.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > FREQUENT)
    return np.sort(counts.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).select("key").toArrow().column(0).to_numpy())


_SKETCH = "doc_id long, _row string, id long, fp long, size int, parity array<long>, prefix array<long>"


def _sketches(shingle: int, likeness: float, frequent: np.ndarray):
    from xxhash import xxh3_64_intdigest

    def run(batches):
        for batch in batches:
            ids, prints, sizes, parities, prefixes = [], [], [], [], []
            for text in batch.column(2):
                held = shingle_set(text.as_py(), shingle)
                n = len(held)
                width = max(PARITY, 1 << (2 * n - 1).bit_length())
                odd = np.bincount(held & (width - 1), minlength=width) & 1
                last = np.isin(held, frequent, assume_unique=True)
                ids.append(xxh3_64_intdigest(held.tobytes()))
                prints.append(majority(held))
                sizes.append(n)
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                first = np.concatenate([held[~last], held[last]])[: n - least_shared(n, likeness) + 1]
                prefixes.append(first & KEY)  # equal keys of unequal shingles only add pairs to compare
            arrays = [*(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (ids, prints)), pa.array(sizes, pa.int32()), *(pa.array(x, pa.list_(pa.int64())) for x in (parities, prefixes))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], [x.split()[0] for x in _SKETCH.split(", ")])

    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            found = [shingle_set(x.as_py(), shingle).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], ["src", "slice", "id", "hashes"])

    return run


def _folded(parity: Column, places: Column) -> Column:
    """The parities of half as many hash classes where there are more than ``places`` longs of them; sets alike in size are one step apart at most."""
    halves = F.zip_with(F.slice(parity, F.lit(1), places), F.slice(parity, places + 1, places), lambda a, b: a.bitwiseXOR(b))
    return F.when(F.size(parity) > places, halves).otherwise(parity)


def _small(parity: Column) -> Column:
    """The parities of SMALL * 64 hash classes."""
    return F.transform(F.sequence(F.lit(0), F.lit(SMALL - 1)), lambda i: F.aggregate(F.sequence(i, F.size(parity) - 1, F.lit(SMALL)), F.lit(0).cast("long"), lambda held, j: held.bitwiseXOR(F.get(parity, j))))


def _similar(likeness: float):
    """The sets of src and of the ids paired with it to the pairs that are similar."""

    def run(key, table):
        src, held = key[0].as_py(), dict(zip(table.column("id").to_pylist(), table.column("hashes")))
        own = np.frombuffer(held.pop(src).as_py(), np.int64)
        found = [k for k, x in held.items() if similar(own, np.frombuffer(x.as_py(), np.int64), likeness)]
        return pa.table({"src": pa.array([src] * len(found), pa.int64()), "dst": pa.array(found, pa.int64())})

    return run


def _fingerprint_pairs(classes: DataFrame, within: int) -> DataFrame:
    """Pairs (src, dst) of class ids whose fingerprints are equal or within so many bits, the least id standing for those of one fingerprint."""
    firsts = classes.groupBy("fp").agg(F.min("id").alias("first"))
    equal = classes.join(firsts, "fp").where(F.col("id") != F.col("first")).select(F.col("first").alias("src"), F.col("id").alias("dst"))
    of = [firsts.select(F.col("fp").alias(x), F.col("first").alias(f"{x}_id")) for x in ("src", "dst")]
    near = hamming_pairs(firsts.select("fp"), within).join(of[0], "src").join(of[1], "dst")
    return equal.union(near.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst")))


def components(docs: DataFrame, likeness: float = 0.8, shingle: int = 5, within: int = 3, most_shipped: int = 500_000, slice_of: int = 256) -> DataFrame:
    """doc_id, _row and root (equal for the rows of one component), one row per row of docs."""
    spark = docs.sparkSession
    bound_batches(spark)
    space = Workspace(spark, "near-copies")
    texts = _with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))).select("doc_id", ROW, "text")
    sketches, sketched = space.table(texts.mapInArrow(_sketches(shingle, likeness, _frequent(texts, shingle)), _SKETCH), "sketches")
    rows, _ = space.table(sketches.select("doc_id", ROW, "id"), "rows")
    classes, _ = space.table(sketches.groupBy("id").agg(F.min(ROW).alias("sample"), F.min("fp").alias("fp"), F.min("size").alias("size"), F.min("parity").alias("parity")), "classes")

    def sized(a: str, b: str):
        return (F.col(a) >= F.col(b) * likeness - 1e-9) & (F.col(b) >= F.col(a) * likeness - 1e-9)

    def most(sizes: Column) -> Column:
        """The differences that two similar sets can have, by the sum of their sizes."""
        return sizes * ((1 - likeness) / (1 + likeness)) + 1e-6

    def linked(pairs: DataFrame, label: str) -> DataFrame:
        """Those of the pairs (src, dst) of class ids that are similar."""
        sketch = [classes.select(F.col("id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("size", "parity", "sample"))) for x in ("src", "dst")]
        places = F.least(F.size("parity_src"), F.size("parity_dst"))
        differ = F.zip_with(_folded(F.col("parity_src"), places), _folded(F.col("parity_dst"), places), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        differ = F.aggregate(differ, F.lit(0), lambda held, x: held + x)
        close = pairs.join(sketch[0], "src").join(sketch[1], "dst").where(differ <= most(F.col("size_src") + F.col("size_dst")))
        close, _ = space.table(close.select("src", "dst", "sample_src", "sample_dst"), f"{label}-close")
        slices = max(1, -(-close.count() // slice_of))  # so that no source has many more than slice_of in one
        close = close.withColumn("slice", F.pmod(F.xxhash64("dst"), F.lit(slices)))
        ends = [close.select("src", "slice", F.col(x).alias("id"), F.col(f"sample_{x}").alias("sample")) for x in ("src", "dst")]
        asked, _ = space.table(ends[0].distinct().union(ends[1]), f"{label}-asked")
        asked = F.broadcast(asked) if asked.count() <= most_shipped else asked
        held = texts.join(asked, F.col(ROW) == F.col("sample")).select("src", "slice", "id", "text")
        sets = held.mapInArrow(_sets(shingle), "src long, slice long, id long, hashes binary")
        return space.table(sets.groupBy("src", "slice").applyInArrow(_similar(likeness), "src long, dst long"), f"{label}-linked")[0]

    def parted(rows: DataFrame, links: DataFrame) -> DataFrame:
        """rows (with id) and the part each belongs to by the links."""
        return rows.join(connected_components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")

    links = linked(_fingerprint_pairs(classes.select("id", "fp"), within), "simhash")

    keyed = parted(sketches.select("id", "size", "prefix").dropDuplicates(["id"]), links).select("id", "size", "part", F.explode("prefix").alias("key"))
    of_key = W.partitionBy("key")
    shared = keyed.withColumn("n", F.count("*").over(of_key)).withColumn("least", F.min(F.struct("id", "size", "part")).over(of_key)).where("n > 1").drop("n")
    shared, _ = space.table(shared, "shared")
    space.drop(sketched)

    star = shared.where((F.col("part") != F.col("least.part")) & sized("size", "least.size")).select(F.col("least.id").alias("src"), F.col("id").alias("dst")).distinct()
    links = links.union(linked(star, "star"))
    parts = parted(shared.select("key", "id", "size"), links)
    parts = parts.withColumn("low", F.min("part").over(of_key)).withColumn("high", F.max("part").over(of_key)).where("low < high")
    small = classes.select("id", _small(F.col("parity")).alias("small"))
    parts, _ = space.table(parts.select("key", "id", "size", "part").join(small, "id"), "parts")
    a, b = (parts.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("id", "size", "part", "small"))) for x in ("a", "b"))
    differ = sum((F.bit_count(F.col("small_a")[i].bitwiseXOR(F.col("small_b")[i])) for i in range(SMALL)), F.lit(0))
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("part_a") != F.col("part_b")) & sized("size_a", "size_b") & (differ <= most(F.col("size_a") + F.col("size_b")))
    rest = a.join(b, "key").where(apart)
    rest = rest.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")).distinct()
    final = connected_components(links.union(linked(rest, "rest"))).withColumnRenamed("node", "id")
    return rows.join(final, "id", "left").select("doc_id", ROW, F.coalesce("component", "id").alias("root"))


def keep_one(docs: DataFrame, likeness: float = 0.8, shingle: int = 5) -> DataFrame:
    """One row of docs for each component: that of the least doc_id, then of the least text hash; a row without a doc_id only where none has one."""
    space = Workspace(docs.sparkSession, "near-copies-keep")
    marks, _ = space.table(components(docs, likeness, shingle), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW)).alias("first")
    stay, _ = space.table(marks.groupBy("root").agg(first).select(F.col(f"first.{ROW}").alias(ROW)), "stay")
    # merged at every size: the same plan, hence the same growth, with few documents as with many
    row = fresh(docs, "row_key")
    repeated = marks.groupBy(ROW).count().where("count > 1").join(stay, ROW, "left_semi").limit(1).count()
    stay = stay.withColumnRenamed(ROW, row)
    kept = _with_row(docs, row).join(stay.hint("merge"), row, "left_semi")
    return (kept.dropDuplicates([row]) if repeated else kept).drop(row)
