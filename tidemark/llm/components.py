"""Connected components of an edge table, round by round on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def _kept(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the ``(a, b)`` edges; the root is the smallest node reachable.

    Alternating star rounds: first every node's larger neighbours are tied to its
    smallest neighbour, then its smaller ones. Each round is a minimum by node,
    which is pre-aggregated, and one join; the edge table never grows, and a star
    forest is reached after a number of rounds that is logarithmic in practice.
    Every round is written by ``checkpoint()``, so a lost executor costs one round.
    """
    edges = _kept(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    while True:
        # Large star: each node's larger neighbours go to the least of it and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("m").alias("a"), "b").distinct()
        # Small star: each node's smaller neighbours, and itself, go to the least of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")
        ).filter("a <> b").distinct()
        new = _kept(small)
        # Done once no node has two parents and no parent has one.
        parents = new.select(F.col("b").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        children = new.select(F.col("a").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        open_nodes = (
            parents.unionByName(children).groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .filter("up > 1 or (up > 0 and down > 0)")
        )
        edges = new
        if open_nodes.isEmpty():
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
