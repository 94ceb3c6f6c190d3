"""Connected components of a distributed edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v), u > v: rehangs neighbours under the least one."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        kept = edges.join(least, "u")
        out = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links (a, b) of long ids -> (node, component): the least id reachable, for every linked node.

    Each round costs a few shuffles of the edges and writes them once; the number of rounds grows with the
    logarithm of the longest chain. No neighbourhood is ever gathered, only its minimum.
    """
    edges = scratch.save(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        after = scratch.save(_star(_star(edges, True), False), "edges")
        scratch.drop(edges)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
