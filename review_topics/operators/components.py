"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics.session import cut_lineage, hot_lookup, stage_counted, unstage


def _lowest(edges: DataFrame, smallest: Column) -> tuple[DataFrame, dict]:
    """Smallest node around each ``u`` and its number of edges, kept for the lookup, and what its write has seen.

    ``open`` counts nodes of several edges that are not the smallest around: where both ends of every edge are listed,
    there is none exactly if the edges are stars.
    """
    lowest = edges.groupBy("u").agg(smallest.alias("m"), F.count("*").alias("matches"))
    return stage_counted(lowest, "matches", open=F.count_if((F.col("matches") > 1) & (F.col("m") != F.col("u"))))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges run from larger ``u`` to smaller ``v``."""
    lowest, seen = _lowest(edges, F.min("v"))
    linked = hot_lookup(edges, lowest, ["u"], "matches", seen)
    moved = linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = cut_lineage(moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
    unstage(lowest)
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``, named by the smallest node it reaches.

    A large-star step links every larger neighbour of a node to the smallest node around it, a small-star step a node and its
    smaller neighbours to the smallest of them. The number of rounds grows with the logarithm of the graph; edges that are
    stars already take none, which the first write of a round tells. Each step is written, the last one deleted, and a hub
    with very many edges is split off by ``hot_lookup``, whatever the size of the graph.
    """
    big, small = F.greatest("u", "v"), F.least("u", "v")
    current = cut_lineage(edges.where(F.col("u") != F.col("v")).select(big.alias("u"), small.alias("v")).distinct())
    for _ in range(max_rounds + 1):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest, seen = _lowest(both, F.least(F.min("v"), F.col("u")))
        if not seen["open"]:
            return lowest.select(F.col("u").alias("node"), F.col("m").alias("component"))
        linked = hot_lookup(both, lowest, ["u"], "matches", seen).where(F.col("v") > F.col("u"))
        large = cut_lineage(linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        following = _small_star(large)
        unstage(current, lowest, large)
        current = following
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
