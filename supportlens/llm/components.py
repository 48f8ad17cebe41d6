"""Connected components of a graph that no machine holds, by alternating star operations.

Each round attaches the larger neighbours of a node to its smallest one (large star), then the smaller ones
(small star); the graph becomes stars after a number of rounds that grows with the logarithm of its size
(Kiveris et al., Connected Components in MapReduce and Beyond, 2014). Smallest neighbours are combined on the map
side, and the join that spreads them has its own exchanges on both sides, so that a node with many neighbours can
be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.session import written


def _star(edges: DataFrame, larger: bool, name: str) -> DataFrame:
    """Edges (a > b) after one operation, written."""
    if larger:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pick, least = F.col("b") > F.col("a"), F.least(F.min("b"), F.col("a"))
    else:
        sides, pick, least = edges, F.lit(True), F.min("b")
    centre = written(sides.groupBy("a").agg(least.alias("least")), f"{name}-centre")
    moved = sides.filter(pick).join(centre, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        moved = moved.unionByName(centre.select("a", F.col("least").alias("b")))
    return written(moved.filter("a > b").distinct(), name)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; the component is its smallest node.

    ``links`` has two integer columns ``a`` and ``b`` in any order; repeated links, loops and rows with a null
    are harmless. Nodes without a link to another one aren't returned.
    """
    known = links.filter("a IS NOT NULL AND b IS NOT NULL")
    ordered = known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ordered.filter("a > b").distinct(), "links")
    state = None
    while True:
        edges = _star(_star(edges, True, "large"), False, "small")
        # In stars, no centre is attached to another node, and rounds change nothing more.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = now
