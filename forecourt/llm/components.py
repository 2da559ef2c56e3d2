"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, the least node of its component, for all nodes with an edge.

    ``edges`` has columns ``a`` and ``b``. In every round each node first links its larger neighbours,
    then its smaller ones, to the least node it knows, until only stars are left; the number of rounds grows
    with the logarithm of the longest path. Neighbours are never gathered in a list: a node with
    very many is a minimum, made with partial aggregates, and a join that Spark splits. Loops and
    repeated edges change nothing. Every round is written to the shared folder.
    """
    edges = written(edges.select("a", "b").filter("a <> b").distinct())
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select("a", F.explode(F.array("a", "b")).alias("node"), "m")
        edges = written(small.filter("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b")).distinct())
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())
