"""Connected components of a link table by alternating large and small stars.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round replaces links by
links to smaller neighbours and settles when every node links to the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node but the roots themselves; ``links`` has bigint columns ``a`` and ``b``.

    Every round is written to the shared folder, so lineage stays short. Only a row count and a checksum
    of the links reach the driver. The smallest neighbour of a node is found by a combined aggregate and
    joined back, so the neighbours of a hub are never gathered.
    """
    edges = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    seen = checksum(edges)
    while True:
        edges = written(small_star(large_star(edges)), "links")
        now = checksum(edges)
        if now == seen:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = now


def checksum(edges: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mark).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Links from every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("lo", "hi")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    larger = both.where("other > node").join(least, "node")
    return larger.select(F.col("other").alias("hi"), F.col("least").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links from a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = edges.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), "least")
    return moved.union(least).toDF("hi", "lo").distinct()
