"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import materialize

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _round(edges: DataFrame, star) -> DataFrame:
    return materialize(star(edges).filter("a <> b").distinct())


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``a, b``; the root is its component's least node.

    Each star only takes minima per node, so that a hub costs one partial aggregate per task and a
    join that adaptive execution may split; no neighbourhood is ever gathered. Every round is
    written to the shared scratch folder. An empty edge table gives no rows.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = _round(_round(edges, _large_star), _small_star)
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                roots.select("node", F.col("node").alias("root"))
            )
        seen = state
    raise RuntimeError("components did not settle")
