"""Connected components of an edge table, by alternating stars over written tables.

Each round links every node to the smallest node it knows (large star, then small star), with two groupings and two
joins; groupings combine before the shuffle and AQE splits the partitions of a hub in the joins. These are merge joins
whatever the sizes: a broadcast passes through the driver, and there would be two or more a round. The rounds end
when the edges no longer change, which takes about as many rounds as the logarithm of the longest path. Every round is
a table in the shared folder, so a lost executor costs a re-read and no lineage grows; a round goes when the next is
written. Two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import materialize, release_since, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the smallest of its neighbours and itself."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where(F.col("v") > F.col("u")).join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node and itself are linked to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.hint("merge"), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v): the smallest node reachable. A node without an edge is not listed."""
    kept = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    place = written()
    kept = materialize(kept, name)
    before = None
    while True:
        mark = kept.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before or not mark["n"]:
            break
        before = mark
        kept = materialize(_small_star(_large_star(kept)).distinct(), name)
        # the round before is read by nothing any more
        release_since(edges.sparkSession, place, kept)
    # a star: every node but the root has one edge, to the root
    return kept.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        kept.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
