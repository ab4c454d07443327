"""Distributed union-find: connected components by contraction, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b of type long); all nodes of a component have the same root.

    Each round gives nodes a new random order, sends every node to its first neighbour if that comes before it, and
    replaces the ends of the edges. Rounds grow with the logarithm of the longest path; minima combine on the map side,
    and the joins are between plain exchanges, so Spark can split a node that has a third of all edges.
    """
    ends = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).alias("e")
    left = stored(edges.where("a <> b").select(ends).distinct().select("e.*"))
    steps: list[DataFrame] = []
    while not left.isEmpty():
        order = F.lit(len(steps))
        ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("w")
        near = left.select(ways).select("w.*").groupBy("a").agg(F.min_by("b", F.xxhash64("b", order)).alias("b"))
        first = F.xxhash64("b", order) < F.xxhash64("a", order)
        step = stored(near.select(F.col("a").alias("node"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("to")))
        to_a = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        to_b = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = left.join(to_a, "a").join(to_b, "b").where("ta <> tb")
        moved = moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        left = stored(moved)
        steps.append(step)
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        after = step.select(F.col("node").alias("root"), F.col("to").alias("next"))
        out = out.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return stored(out)
