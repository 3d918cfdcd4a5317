"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.scratch import stored

MOST_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node points its neighbours at the smallest node it knows.

    First for larger neighbours, then for the node itself and its smaller neighbours.
    Minima are partially aggregated; a node with many links meets them by a join whose
    hot partitions adaptive execution splits.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, F.col("a") == F.col("u")).select("b", "m")
    large = large.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # Here a > b: a node and its smaller neighbours.
    smallest = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(smallest.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a``, ``b``): the smallest node it reaches.

    Each round is written to the shared folder, which cuts lineage; the rounds end when
    the star table stays as it was. Nodes without links are left out; self-links and
    repeated links change nothing.
    """
    edges = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    for _ in range(MOST_ROUNDS):
        edges = stored(_stars(edges), "stars")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
