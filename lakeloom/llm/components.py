"""Connected components of a graph of links, by large-star and small-star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.storage import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame) -> DataFrame:
    """Edges with the least of ``u`` and its neighbours. The minimum is folded before the
    shuffle, and the join's other side stays apart so that a hub's edges can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"), F.xxhash64("u").alias("_k"))
    return edges.withColumn("_k", F.xxhash64("u")).join(least, ["u", "_k"]).drop("_k")


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``component``, the least node that links reach, for every node that
    differs from it. Links with a null end, from a node to itself, or repeated change
    nothing; without links the result is empty.

    Each round is written to the shared folder, so a lost executor costs one round.
    """
    a, b = F.col(first), F.col(second)
    edges = links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _least(large)
        small = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
