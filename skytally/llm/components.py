"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.session import cut_lineage

EDGES_PER_FILE = 50_000


def _star(edges: DataFrame, keep) -> DataFrame:
    """Connect the neighbours of each node that ``keep`` takes to the least of node and neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root of every node with an edge; the root is the component's least node.

    ``edges`` has long columns u and v. Each round writes its edges to the shared folder, a file per
    ``EDGES_PER_FILE`` of them, as rounds are many and none has more edges and nodes than the first; the number
    of rounds grows with the logarithm of the longest path.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = cut_lineage(oriented(edges))
    files = max(1, math.ceil(edges.count() / EDGES_PER_FILE))
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = oriented(_star(both, F.col("v") > F.col("u")))
        # Small star: a node and its lesser neighbours; the node itself is connected too.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        edges = cut_lineage(oriented(small.unionByName(own)).coalesce(files))
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
