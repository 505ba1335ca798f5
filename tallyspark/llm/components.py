"""Connected components of an edge table, by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).

Every step is a map-side combined minimum per node and one join. Both sides of
each join are stored tables, so AQE can split the partition of a node with
very many neighbours. Nothing is collected; each round's edge table is written
to the shared folder and the previous one deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import stage, unstage


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (long columns ``a``,
    ``b``), ``component`` being the smallest node reachable. Loops, repeated
    and reversed edges are allowed; edges with a null end are ignored; an
    empty table gives an empty result."""
    e = stage(edges.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    mark = _fingerprint(e)
    while mark[0]:
        # large star: every larger neighbour moves to the smallest of the neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        star = stage(e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
                     .select(F.col("w").alias("u"), F.col("m").alias("v")).distinct(), "cc-star")
        unstage(e, low)
        # small star: every smaller neighbour and the node itself move to the smallest one
        low = stage(star.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        moved = (star.join(low, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = stage(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        unstage(star, low)
        before, mark = mark, _fingerprint(e)
        if before == mark:
            break
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
