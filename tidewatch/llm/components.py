"""Connected components of a graph too large for one machine: alternating large-star and small-star steps.

Each step is an aggregation to the least neighbour, combined before the shuffle, and a join with one row a node, whose
hot side Spark splits; every round is written to the shared folder, so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _sign(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def least_reachable(edges: DataFrame) -> DataFrame:
    """node, root for every node of an edge (u, v longs) that isn't the smallest of its component."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = _sign(edges)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        edges = materialize(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        after = _sign(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
