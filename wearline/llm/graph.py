"""Connected components of links between distinct items, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import materialised


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame, *, larger: bool) -> DataFrame:
    """Hang neighbours of each node on the smallest node around it; ``pairs`` has a node ``u`` and a neighbour ``v``."""
    lowest = materialised(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "star")
    joined = pairs.join(lowest, "u")
    hung = joined.where("v > u") if larger else joined.where("v <> low")
    out = hung.select(F.col("v").alias("a"), F.col("low").alias("b"))
    if not larger:
        out = out.union(lowest.select(F.col("u").alias("a"), F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of ``links`` (a, b); the root is the smallest node reachable.

    Alternates stars over larger and smaller neighbours until nothing changes, which takes a number of rounds that
    grows with the logarithm of the size. Each round is stored, so no lineage builds up. No links, no rows.
    """
    edges = materialised(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(edges)
    while True:
        both = edges.selectExpr("a AS u", "b AS v").union(edges.selectExpr("b AS u", "a AS v"))
        grown = materialised(_star(both, larger=True), "large-star")
        edges = materialised(_star(grown.selectExpr("a AS u", "b AS v"), larger=False), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
