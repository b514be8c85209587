"""Connected components of an edge table, by alternating large-star and small-star.

(Kiveris et al., 2014.)  Every node points to ever smaller neighbours until
each component is a star around its least node.  A node's least neighbour is
found by aggregation, which a hub enters once a task; all nodes of a small table,
or the hubs of a large one, then hand theirs to their edges by broadcast, so that
no task gathers the edges of a hub.  Rounds
are written to the shared folder, so lineage stays short and a lost executor
costs one round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

#: Edges of a hub at least, and hubs at most: a node is one if it has HUB edges and one in HUBS / 2 of all edges.
HUB, HUBS = 64, 20_000
#: Edges up to which the nodes, at most twice as many, are broadcast.
SMALL = 100_000


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: Column, degree: int) -> DataFrame:
    """edges (a, b) with m, the least of each a's neighbours (and more, by `least`); degree 0: all nodes are broadcast."""
    if not degree:
        return edges.join(F.broadcast(edges.groupBy("a").agg(least.alias("m"))), "a").select("a", "b", "m")
    m = edges.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("n"))
    # each hub has `degree` of all edges or more, so hubs are HUBS at most
    hubs = F.broadcast(m.where(F.col("n") >= degree).select(F.col("a").alias("_hub"), F.col("m").alias("_m")))
    marked = edges.join(hubs, F.col("a") == F.col("_hub"), "left")
    others = marked.where("_hub is null").select("a", "b").join(m.where(F.col("n") < degree).select("a", "m"), "a")
    return marked.where("_hub is not null").select("a", "b", F.col("_m").alias("m")).union(others.select("a", "b", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node reachable."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _sum(edges)
    while before[0]:
        degree = max(HUB, -(-2 * before[0] // HUBS)) if before[0] > SMALL else 0
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, F.least(F.min("b"), F.min("a")), degree).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        moved = _with_least(large, F.min("b"), degree)
        # an edge to the least itself stays, every other moves there
        edges = staged(moved.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        after = _sum(edges)
        if after == before:
            break
        before = after
    # every node points to its root now: the roots themselves are added once
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
