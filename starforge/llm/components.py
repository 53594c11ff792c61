"""Connected components of a link table by alternating star contraction.

Nodes are longs, links a table (a, b) with a != b. In a large star every node hands its larger
neighbours to its least neighbour, in a small star its smaller ones; repeated, each component
becomes one star around its least node (Kiveris et al., "Connected Components in MapReduce
and Beyond"). Every half step is a grouped minimum and a join, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import stored


def _star(pairs: DataFrame, keep) -> DataFrame:
    """pairs (u, v): hand each v that ``keep`` names to the least of u and its v's."""
    least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
    return pairs.join(least, "u").where(keep).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links``; root is the least node of its component. No links, no rows."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "cc")

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))")).first()

    before = mark(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        edges = stored(_star(both, F.col("v") > F.col("u")).distinct(), "cc")
        down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        # a small star also hands the node itself to its least neighbour
        least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        handed = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b")
        edges = stored(handed.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "cc")
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
