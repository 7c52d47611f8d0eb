"""Connected components of a table of links, by alternating star contractions.

Every round links each node to its smallest neighbour (first across larger neighbours, then
across smaller ones) and writes the links to the shared folder; the number of rounds grows
with the logarithm of the longest path. Minima are combined before the shuffle and joined
back, so a node with very many links never has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of its component."""
    edges = staged(_oriented(links.select("a", "b")), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = staged(_small_star(_large_star(edges)), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Larger node first, each link once."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame):
    """Number of links and an order-free checksum."""
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionByName(least.select("a", F.col("m").alias("b"))))
