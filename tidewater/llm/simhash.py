"""SimHash near-duplicates, with candidates by pigeonring filtering.

A fingerprint is 64 bits cut into a ring of SEGMENTS consecutive segments. If two
fingerprints differ in at most t bits, then from some segment on every chain of l
consecutive segments holds at most floor(l * t / SEGMENTS) of the differences. The
longest chain that may hold none is the key of an equi-join (one key for each
start); the longer chains are tested inside the join, before the full Hamming
check. Every pair within t bits is found.

Equal fingerprints are one class with one row in the search, so a large group of
copies costs one candidate. A key that more than ``split_over`` classes share is
split further: the bits outside the key hold at most t differences, so they form
a ring of their own and give a second, longer key. That changes the cost only.

Defined cases: a null, empty or blank text has fingerprint zero, linked like any
other; a null doc_id takes part, and a component of null ids alone has a null id;
repeated rows stay, one result row for each; an empty table gives an empty
result; no column but doc_id and text is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches
from tidewater.operators.graph import connected_components
from tidewater.workspace import Workspace

SEGMENTS, SEED = 7, 42


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a UTF-8 text, A-Z in lower case."""
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(line, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        first, last = (ends - sizes)[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist()
        hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(first, last)]
    return majority(np.array(hashes, "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint of 64-bit hashes (at least one): each bit that is set in over half of them."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long), one row per row of docs."""

    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column(1)]
            prints = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, fp long")


def _ring(bits: list[int]) -> list[list[int]]:
    """The given bit places as SEGMENTS masks of about equal size."""
    return [[int(x) for x in part] for part in np.array_split(bits, SEGMENTS)]


def _mask(places: list[int]) -> int:
    value = sum(1 << x for x in places)
    return value - (1 << 64) if value >> 63 else value


def _chains(bits: list[int], within: int) -> list[tuple[int, list[int], list[tuple[int, int]]]]:
    """For each start: the mask that must agree, the places outside it, and (mask, most differences) of each longer chain."""
    ring, free = _ring(bits), (SEGMENTS - 1) // within if within else SEGMENTS
    out = []
    for start in range(SEGMENTS):
        turn = [ring[(start + k) % SEGMENTS] for k in range(SEGMENTS)]
        key = sum(turn[:free], [])
        longer = [(_mask(sum(turn[:n], [])), n * within // SEGMENTS) for n in range(free + 1, SEGMENTS + 1)]
        out.append((_mask(key), sorted(set(bits) - set(key)), longer))
    return out


def hamming_pairs(prints: DataFrame, within: int = 2, split_over: int = 256) -> DataFrame:
    """All pairs (src < dst) of the distinct longs in prints.fp that differ in 1 to ``within`` bits (within under SEGMENTS)."""
    space = Workspace(prints.sparkSession, "hamming")
    chains = _chains(list(range(64)), within)
    keyed = prints.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(c[0])).alias("key")) for i, c in enumerate(chains)])
        ).alias("k"),
    ).select("fp", "k.start", "k.key")
    crowded = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1").select("start", "key", (F.col("n") > split_over).alias("split"))
    shared, _ = space.table(keyed.join(crowded, ["start", "key"]), "shared")

    def close(start: int, longer: list[tuple[int, int]]):
        differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
        holds = F.col("a.start") == start
        for mask, most in longer:
            holds = holds & (F.bit_count(differ.bitwiseAND(F.lit(mask))) <= most)
        return holds

    viable = F.lit(False)
    for i, (_, _, longer) in enumerate(chains):
        viable = viable | close(i, longer)
    near = viable & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= within) & (F.col("a.fp") < F.col("b.fp"))

    plain = shared.where("not split")
    same = (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key"))
    pairs = plain.alias("a").join(plain.alias("b"), same & near).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))

    inner = [[k[0] for k in _chains(rest, within)] for _, rest, _ in chains]
    second = F.lit(None).cast("array<long>")
    for i, masks in enumerate(inner):
        second = F.when(F.col("start") == i, F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).otherwise(second)
    crowd = shared.where("split").select("fp", "start", "key", F.posexplode(second).alias("turn", "also"))
    same = same & (F.col("a.turn") == F.col("b.turn")) & (F.col("a.also") == F.col("b.also"))
    more = crowd.alias("a").join(crowd.alias("b"), same & near).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
    return pairs.union(more).distinct()


def near_duplicates(docs: DataFrame, within: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable), one row per row of docs."""
    space = Workspace(docs.sparkSession, "simhash")
    rows, _ = space.table(fingerprints(docs, shingle), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = connected_components(hamming_pairs(classes.select("fp"), within))
    rooted = classes.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    rooted, _ = space.table(rooted, "classes")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(named, "root").select(F.col("fp").alias("of"), "component_id")
    return rows.join(labels, F.col("fp") == F.col("of"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
