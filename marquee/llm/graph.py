"""Connected components of links that no single machine could hold, by DataFrame joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialize

ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """Smallest node of each component, from links (a, b) in either direction.

    Columns: node, root; nodes without a link do not appear. Links are rewritten by turns of large and small
    stars: every node hands its larger neighbours to the smallest one it knows, then the smaller ones. Paths
    shorten geometrically, no node's neighbours are ever gathered, and the links never grow in number. Each
    round is written to the shared folder, so a lost executor costs a part of one round.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = materialize(edges, "links")
    for _ in range(ROUNDS):
        if _are_stars(edges):
            break
        edges = materialize(_small_star(_large_star(edges)), "links")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has just one link, to a smaller root."""
    out, into = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")), edges.select(F.col("b").alias("node"), F.lit(2).alias("up"))
    roles = out.unionByName(into).groupBy("node").agg(F.count(F.when(F.col("up") == 1, 1)).alias("links"), F.max("up").alias("most"))
    return roles.filter((F.col("links") > 1) | ((F.col("links") == 1) & (F.col("most") == 2))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node linked to the smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    found = edges.select(F.col("b").alias("a"), F.col("a").alias("far")).join(least, "a")
    return found.select(F.col("far").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    near = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return near.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
