"""Connected components by alternating large-star and small-star contraction.

Every step is a grouped minimum (partially aggregated before its shuffle) and a
join of the edges with their node's minimum. Nodes with more than ``most`` edges, at
most HOT_NODES of them, meet their edges by broadcast where these lie; only the
edges of other nodes are shuffled. So no task gets all edges of a hot node. The number
of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.workspace import Workspace


#: Nodes whose minimum is broadcast, at most; and the edges that make a node hot, at least.
HOT_NODES, HOT_EDGES = 4000, 256


def _with_least(edges: DataFrame, least: DataFrame, most: int | None) -> DataFrame:
    """edges (u, v) with u's m of least (u, m, n); most is None where no node is hot."""
    if most is None:
        return edges.join(least.select("u", "m"), "u")
    hot = F.broadcast(least.where(F.col("n") > most).select("u", F.col("m").alias("hot")))
    marked = edges.join(hot, "u", "left")
    cold = marked.where("hot is null").select("u", "v").join(least.where(F.col("n") <= most).select("u", "m"), "u")
    return marked.where("hot is not null").select("u", "v", F.col("hot").alias("m")).union(cold.select("u", "v", "m"))


def _large_star(edges: DataFrame, most: int | None) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    return _with_least(both.where("v > u"), least, most).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, most: int | None) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _with_least(edges, least, most).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component) for every node that has an edge to another; component is the least node reachable.

    Null ends and loops are ignored, repeated edges count once, an empty table gives an empty result.
    """
    spark = edges.sparkSession
    space = Workspace(spark, "components")
    now, path = space.table(
        edges.where(f"{src} <> {dst}").select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == state or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state, old = tuple(mark), path
        most = max(HOT_EDGES, 2 * mark[0] // HOT_NODES)  # the edges have 2 * mark[0] ends
        ends = now.select("u").union(now.select(F.col("v").alias("u")))
        if not ends.groupBy("u").count().where(F.col("count") > most).limit(1).count():  # then none is hot after the large star either
            most = None
        now, path = space.table(_small_star(_large_star(now, most), most), "edges")
        space.drop(old)
