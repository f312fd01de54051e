"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    near = both.join(least.hint("merge"), "a").where("b > a")
    return near.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    near = down.join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return near.unionByName(least.withColumnRenamed("least", "b")).where("a != b").distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of an edge (``a``, ``b``) that is not its component's least one.

    Nodes may be of any type that can be ordered. Each round is a stored table;
    it ends when a round changes nothing. Minima are combined before they are
    shuffled and hot nodes of the joins are split by adaptive execution.
    """
    edges = stored(edges.select("a", "b").where("a != b").distinct(), f"{folder}/edges-0")
    seen, turn = None, 0
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max(F.xxhash64("b", "a"))
        ).first()
        if state[0] == 0 or state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, turn = state, turn + 1
        edges = stored(_small_star(_large_star(edges)), f"{folder}/edges-{turn}")
