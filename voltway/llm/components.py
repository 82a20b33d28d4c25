"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltway.llm import common


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node, component for every node of ``edges`` (u, v: long); a component's id is its smallest node.

    Nothing is collected but a count and two 64-bit checksums of the edges per
    round, which stay as they are only if the edges do. Rounds grow with the
    logarithm of the nodes; an unfinished result raises.
    """
    state = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state, before = common.checkpointed(state), None
    for _ in range(rounds):
        state = common.checkpointed(small_star(large_star(state)))
        now = tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError(f"components aren't settled after {rounds} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
