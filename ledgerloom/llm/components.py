"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored


def star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest one: larger neighbours only, or smaller ones and itself."""
    if large:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    low = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a > b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): the smallest node it is connected with.

    Each round is written to the shared folder; minima are combined before the shuffle and joins on a hot node are
    split by adaptive execution, so a node with very many neighbours is no single task.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before = stored(pairs, "edges"), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        pairs = stored(star(star(pairs, True).distinct(), False).distinct(), "edges")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
