"""Connected components of a graph of long ids, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest id around the node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    near = least.select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest id reachable.

    Self links, repeated links and links with a null end are ignored.  Every round is a written table, and the
    number of rounds grows with the logarithm of the graph, not with its diameter.
    """
    known = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    now = stage(
        edges.where(known).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
