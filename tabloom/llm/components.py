"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is hung on the smallest one."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest reachable id for every node of ``edges`` (a, b) but the smallest itself.

    Each round is written to the shared folder; the rounds end when the stars no longer change.
    Stars are minima per node, so no group of neighbours is gathered.
    """
    state = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or not now[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now
        state = saved(_small_star(_large_star(state)), "edges")
