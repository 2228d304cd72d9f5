"""Connected components of a graph of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import small_side
from corpusloom.session import cut_lineage

_BROADCAST_ROWS = 300_000


def _apart(least: DataFrame) -> DataFrame:
    """One row per node, stored, so that a join with it can deal out the edges of a hub."""
    return small_side(cut_lineage(least), _BROADCAST_ROWS)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _apart(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _apart(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _state(edges: DataFrame) -> tuple:
    seen = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(seen), F.sum(F.shiftright(seen, 20))).collect()[0])


def smallest_members(edges: DataFrame) -> DataFrame:
    """(u, v): each node that has an edge and is not the smallest of its component, with that smallest one.

    ``edges`` is (u, v) of any one ordered type; loops are left out. The rows made per
    round grow with the edges, and the rounds with the logarithm of their number.
    """
    current = cut_lineage(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct())
    before, now = None, _state(current)
    while now != before:
        current = cut_lineage(_small_star(_large_star(current)))
        before, now = now, _state(current)
    return current
