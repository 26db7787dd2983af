"""Connected components of an undirected edge table by alternating large-star and
small-star steps (Kiveris et al., 2014). Every step is a grouped minimum (combined
before its shuffle) and an equi-join on the node, so a node with very many neighbours
is a skewed join, which Spark splits; the edge table never grows, and each round is
written to the shared checkpoint folder, so lost executors cost one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.materialize import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` → ``(node, component)`` for every node that has an edge;
    ``component`` is the smallest node reachable. Self-loops, null ends and repeated
    edges change nothing; an empty table gives an empty result."""
    stars = checkpointed(edges.where("u <> v").select("u", "v").distinct(), "cc")
    state = _state(stars)
    while state[0]:
        stars = checkpointed(_small_star(_large_star(stars)), "cc")
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
