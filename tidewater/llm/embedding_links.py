"""Embedding near-duplicates by sorted projection passes.

Each pass draws 63 random hyperplanes, orders the vectors lexicographically by
their side of each, and compares every vector with those up to ``window`` places
further on, by cosine in double precision. A block of places gives one row per
linked vector, naming the least of those that it is linked with in the block; the
verified links of all passes are united into connected components. There, every
pair is compared: a component that fits into one task there, a larger one in blocks
of its members, each with each. So neither pairs nor repeated finds are emitted, the
links within a component are exact whatever its size, and the window decides
only whether two vectors that nothing else connects are found.

That chance follows from the window: two vectors at the limit are on the same side
of a hyperplane with probability p = 1 - acos(limit) / pi, so they share a cell that
the window covers, log2(n / window) + 1 planes deep, with about p to that power a
pass. ``passes_for`` takes as many passes as leave less than ``miss``, so passes
grow with the table; a table within one window takes one pass and is exact.

Equal vectors are one class that takes one place, whatever their number. Vectors of
float components travel as such (their doubles are exact), others as doubles; a product
in floats settles a pair only where it is further from the limit than its rounding.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a vec_id, link with nothing and are their own
component; vectors of different lengths never link; where rows repeat a vec_id
the least of their vectors counts and each row gets the result; an empty table
gives an empty result; no column but vec_id and embedding is read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidewater.operators.graph import connected_components
from tidewater.workspace import Workspace

PLANES = 63
#: Bytes of vectors in each of the two parts of a component that one task compares.
PART_BYTES = 4 << 20


def passes_for(n: int, window: int, limit: float, miss: float) -> int:
    """Passes that leave a pair at the limit uncompared with a chance of at most ``miss``, among n vectors in general position."""
    if n <= window:
        return 1
    found = (1 - math.acos(limit) / math.pi) ** (math.log2(n / window) + 1)
    return math.ceil(math.log(miss) / math.log1p(-found))


def _unit(data: list[bytes], kind: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


@lru_cache(256)
def _planes(turn: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, turn, width]).standard_normal((width, PLANES))


def _by_width(data: list[bytes]) -> list[np.ndarray]:
    """Places of the vectors of each length."""
    widths = np.array([len(x) for x in data], np.int64)
    return [np.flatnonzero(widths == size) for size in np.unique(widths)]


def _keys(passes: int, seed: int, kind: str):
    """(rep, vector) to a row (turn, key, rep) for each pass."""
    powers = np.int64(1) << np.arange(PLANES - 1, -1, -1, dtype=np.int64)

    def run(batches):
        for batch in batches:
            reps, data = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for own in _by_width(data):
                rows = _unit([data[k] for k in own], kind)
                for turn in range(passes):
                    keys = ((rows @ _planes(turn, rows.shape[1], seed)) > 0) @ powers
                    columns = [np.full(len(own), turn, np.int32), keys, reps[own]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["turn", "key", "rep"])

    return run


def _places(batches):
    """Rows ordered by (turn, key, rep) to (turn, part, rep, place in this part's run of the turn)."""
    part, last, seen = TaskContext.get().partitionId(), -1, 0
    for batch in batches:
        turns = batch.column(0).to_numpy()
        place = np.empty(len(turns), np.int64)
        for turn in np.unique(turns):
            own = np.flatnonzero(turns == turn)
            seen = seen if turn == last else 0
            place[own] = seen + np.arange(len(own))
            last, seen = turn, seen + len(own)
        columns = [batch.column(0), pa.array(np.full(len(turns), part)), batch.column(2), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, ["turn", "part", "rep", "place"])


def _linked(own: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    """The least index linked with each of n, by label propagation over the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[own], label[other])
        np.minimum.at(label, own, low)
        np.minimum.at(label, other, low)
        label = label[label]
        if (label == before).all():
            return label


def _near(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Whether the cosine of each row of a with each row of b (unit vectors, in doubles) reaches the limit."""
    cosine = a.astype(np.float32) @ b.astype(np.float32).T
    near, margin = cosine >= limit, 1e-5 + 1.2e-7 * a.shape[1]
    i, j = np.nonzero(np.abs(cosine - np.float32(limit)) <= margin)
    if len(i):
        near[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= limit
    return near


def _compare(window: int, block: int, limit: float, kind: str):
    """The vectors of a block of places, and of the window behind it, to (rep, least rep linked with it) of the linked ones."""

    def run(key, table):
        start = key[1].as_py() * block
        at = table.column("at").to_numpy()
        order = np.argsort(at)
        at, reps, vectors = at[order], table.column("rep").to_numpy()[order], table.column("vector").to_pylist()
        data = [vectors[k] for k in order]
        found = []
        for held in _by_width(data):
            rows = _unit([data[k] for k in held], kind)
            for first in range(0, len(held), 512):
                mine = held[first : first + 512]
                mine = mine[at[mine] < start + block]
                if not len(mine):
                    break
                last = int(np.searchsorted(at[held], at[mine[-1]] + window, side="right"))
                a, b = np.nonzero(_near(rows[first : first + len(mine)], rows[first:last], limit))
                a, b = mine[a], held[first + b]
                keep = (at[b] > at[a]) & (at[b] - at[a] <= window)
                found.append((a[keep], b[keep]))
        a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        label = _linked(a, b, len(data))
        least = np.full(len(data), np.iinfo(np.int64).max)
        np.minimum.at(least, label, reps)
        hit = np.unique(np.append(a, b))
        hit = hit[least[label[hit]] != reps[hit]]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (reps[hit], least[label[hit]])], ["rep", "root"])

    return run


def _count(limit: float, kind: str, rows_at_once: int = 2048):
    """Members of components (whole ones, or two parts of one) to the links of each with the others here, by their sizes."""

    def run(key, table):
        one, other = key[1].as_py(), key[2].as_py()
        reps, size, part = (table.column(x).to_numpy() for x in ("rep", "size", "part"))
        component, data = table.column("component").to_numpy(), table.column("vector").to_pylist()
        links = np.zeros(len(reps), np.int64)

        def add(a: np.ndarray, b: np.ndarray, same: bool):
            for width in {len(data[k]) for k in a.tolist()}:
                i, j = (np.array([k for k in x.tolist() if len(data[k]) == width], np.int64) for x in (a, b))
                if not len(j):
                    continue
                x, y = (_unit([data[k] for k in own], kind) for own in (i, j))
                for p in range(0, len(i), rows_at_once):
                    for q in range(p if same else 0, len(j), rows_at_once):
                        near = _near(x[p : p + rows_at_once], y[q : q + rows_at_once], limit)
                        if same and p == q:
                            np.fill_diagonal(near, False)
                        u, v = i[p : p + rows_at_once], j[q : q + rows_at_once]
                        links[u] += (near @ size[v].astype(np.float64)).astype(np.int64)
                        if not same or p != q:
                            links[v] += (size[u].astype(np.float64) @ near).astype(np.int64)

        if one == other:
            order = np.argsort(component, kind="stable")
            edges = np.flatnonzero(np.append(True, component[order][1:] != component[order][:-1]))
            for own in np.split(order, edges[1:]):
                add(own, own, True)
        else:
            add(np.flatnonzero(part == one), np.flatnonzero(part == other), False)
        return pa.Table.from_arrays([pa.array(reps), pa.array(links)], ["rep", "links"])

    return run


def _as_bytes(kind: str):
    def run(batches):
        for batch in batches:
            values, offsets = batch.column(1).values.to_numpy(zero_copy_only=False).astype(kind), batch.column(1).offsets.to_pylist()
            data = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary()), batch.column(2)], ["rep", "vector", "size"])

    return run


def _links_within(points: DataFrame, joined: DataFrame, limit: float, kind: str, part_bytes: int) -> DataFrame:
    """rep and links (rows in other classes of its component that it is linked with), exact."""
    members = points.join(joined, points["rep"] == joined["node"]).select("component", "rep", "vector", "size")
    n, width = members.agg(F.count("*"), F.avg(F.octet_length("vector"))).first()
    most = max(64, int(part_bytes // max(width or 1, 1)))
    # components beyond one task: at most n / most of them
    large = joined.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > most)
    large = large.select("component", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    dealt = members.join(F.broadcast(large), "component", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("rep"), "parts"), F.lit(-1)).cast("int"))
    small = F.struct(F.pmod(F.xxhash64("component"), F.lit(max(1, -(-n // most)))).alias("of"), F.lit(-1).alias("one"), F.lit(-1).alias("other"))
    pair = lambda k: F.struct(F.col("component").alias("of"), F.least("part", k).alias("one"), F.greatest("part", k).alias("other"))
    cells = F.when(F.col("parts").isNull(), F.array(small)).otherwise(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), pair))
    spread = dealt.select("component", "rep", "vector", "size", "part", F.explode(cells).alias("cell")).select("*", "cell.*").drop("cell")
    return spread.groupBy("of", "one", "other").applyInArrow(_count(limit, kind), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def link_embeddings(
    vectors: DataFrame, limit: float = 0.9, window: int = 1024, miss: float = 0.002, block: int = 8192, seed: int = 7, part_bytes: int = PART_BYTES
) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (least vec_id reachable), kept, one row per row of vectors."""
    space = Workspace(vectors.sparkSession, "embedding-links")
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind, of = ("<f4", "float") if single else ("<f8", "double")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{of}>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0.0)
    usable = rows.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    if usable.groupBy("vec_id").count().where("count > 1").limit(1).count():
        usable = usable.groupBy("vec_id").agg(F.min("v").alias("v"))
        times = rows.where("vec_id is not null").groupBy("vec_id").agg(F.count("*").alias("times"))
        usable = usable.join(times, "vec_id")
    else:
        usable = usable.withColumn("times", F.lit(1))
    classes = usable.groupBy("v").agg(F.min("vec_id").alias("rep"), F.sum("times").cast("long").alias("size"))
    points, _ = space.table(classes.select("rep", "v", "size").mapInArrow(_as_bytes(kind), "rep long, vector binary, size long"), "classes")

    passes = passes_for(points.count(), window, limit, miss)
    keys = points.select("rep", "vector").mapInArrow(_keys(passes, seed, kind), "turn int, key long, rep long")
    ordered = keys.repartitionByRange("turn", "key", "rep").sortWithinPartitions("turn", "key", "rep")
    placed, _ = space.table(ordered.mapInArrow(_places, "turn int, part long, rep long, place long"), "places")
    counts = placed.groupBy("turn", "part").agg(F.count("*").alias("n"))  # a row per task and pass
    before = W.partitionBy("turn").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("turn", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    places = placed.join(bases, ["turn", "part"]).groupBy("rep").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", (F.col("base") + F.col("place")).alias("at")))), lambda x: x["at"]).alias("places")
    )
    spread = points.join(places, "rep").select("rep", "vector", F.posexplode("places").alias("turn", "at"))
    home = F.floor(F.col("at") / block)
    blocks = F.when((F.col("at") % block < window) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    spread = spread.select("turn", F.explode(blocks).alias("block"), "at", "rep", "vector")
    found = spread.groupBy("turn", "block").applyInArrow(_compare(window, block, limit, kind), "rep long, root long").distinct()

    joined = connected_components(found, "rep", "root")
    links, _ = space.table(_links_within(points, joined, limit, kind, part_bytes), "links")
    labels = points.select("rep", "size").join(links, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    labels = labels.select("rep", "size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("root"))
    members = usable.select("vec_id", "v").join(classes.select("v", "rep"), "v").select(F.col("vec_id").alias("of"), "rep")
    known = members.join(labels, "rep").select("of", (F.col("size") - 1 + F.col("links")).alias("n"), "root")
    return (
        rows.select("vec_id")
        .join(known, F.col("vec_id") == F.col("of"), "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
