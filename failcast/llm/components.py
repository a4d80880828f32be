"""Connected components of an edge table by alternating star contraction.

Each round rewires every node to the smallest node it can see, first among larger
neighbours, then among smaller ones, until nothing changes. A round is written to the
shared folder, so that lineage stays short and lost executors cost one round at most.
Self loops and repeated edges are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from failcast.llm.common import forget, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v) of any orderable type -> (node, root): every linked node with the smallest of its component."""
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = written(links.where("u <> v").select(u, v).distinct())
    before = _print_of(edges)
    while before[0]:
        after_large = _large_star(edges)
        new = written(_small_star(after_large))
        now = _print_of(new)
        forget(edges)
        edges = new
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
