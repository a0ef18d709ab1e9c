"""Connected components over tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import cut


def _stamp(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component), for every node with a link to another.

    ``edges``: a, b (long).  Alternates two rewritings until nothing changes: every node
    passes its greater neighbours on to its least neighbour, then every node passes its lesser
    neighbours and itself on to the least of them.  The rounds grow with the logarithm of
    the longest chain; a round is one pass over the links, and no node gathers its neighbours.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (stamp := _stamp(edges)) != before:
        before = stamp
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = cut(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        passed = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(passed.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
