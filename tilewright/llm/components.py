"""Distributed union-find: connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.shared import stored


def _smaller_first(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _smaller_first(both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    near = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return _smaller_first(near.unionByName(least.select(F.col("m").alias("a"), "b")))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (a, b: long): the smallest node reachable.

    Loops and repeated edges are allowed; nodes without an edge to another are not in the result.
    Rounds grow with the logarithm of the longest path; each is written to the shared folder, and
    only one row of counts reaches the driver. Large groups are reduced before their shuffle
    (min per node) and meet again in a plain join, which adaptive execution can split.
    """
    current = stored(_smaller_first(edges), "edges")
    mark = _mark(current)
    while mark[0]:
        following = stored(_small_star(_large_star(current)), "edges")
        new_mark = _mark(following)
        current = following
        if new_mark == mark:
            break
        mark = new_mark
    members = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
