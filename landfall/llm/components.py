"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stage


def _toward_least(edges: DataFrame, least: DataFrame, name: str) -> DataFrame:
    """(v, m): every v of an edge (u, v) with the least neighbour m of u.

    Both sides are written tables, so a node with very many edges is a partition that can be split.
    """
    return edges.join(stage(least, name).withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(F.col("v"), F.col("m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: the least node of its component, for every node of ``edges`` (u, v) other than the roots.

    Each round hangs the larger neighbours of a node below its least neighbour, then the smaller ones;
    the number of rounds grows with the logarithm of the longest path. Edges stay distributed; only a
    count and a checksum reach the driver. Self-loops and repeated edges do no harm.
    """
    clean = edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, seen = stage(clean, "cc-edges"), None
    for _ in range(most_rounds):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state[0] == 0 or state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _toward_least(both.filter(F.col("v") > F.col("u")), least, "cc-least").filter(F.col("v") != F.col("m"))
        large = stage(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _toward_least(large, least, "cc-least").filter(F.col("v") != F.col("m")).union(least)
        current = stage(small.toDF("u", "v").distinct(), "cc-edges")
    raise RuntimeError("components did not settle")
