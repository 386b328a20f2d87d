"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.session import cut_measured


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` that is not itself its component's smallest.

    Each round ties the larger neighbours of a node to its smallest one, then the smaller
    ones; the rounds grow with the logarithm of the nodes. A node with very many neighbours
    is an aggregate and a join that Spark splits, never one group in a task. Loops, repeated
    and null edges are left out.
    """
    ends = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    clean = edges.where("a is not null and b is not null and a != b")
    state = {"n": F.count("*"), "digest": F.bit_xor(F.xxhash64("u", "v"))}
    links, now = cut_measured(clean.select(*ends).distinct(), "edges", **state)
    before = None
    while now != before and now["n"]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m"))
        near = near.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(near.hint("merge"), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = large.join(low.hint("merge"), "u").select(tied.alias("u"), F.col("m").alias("v")).distinct()
        before = now
        links, now = cut_measured(small, "edges", **state)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
