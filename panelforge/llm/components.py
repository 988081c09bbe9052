"""Connected components of a distributed edge list: contraction to the smallest neighbour, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import materialise, spread_join


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a long, b long); component is the smallest node reachable.

    Each round points every node to the smallest of itself and its neighbours. These pointers are trees, whose roots
    are found by pointer jumping, so depth halves with each jump and a chain of n nodes takes log2(n) of them, not n
    rounds. Edges are then rewritten to roots and loops dropped: only local minima stay, and a round in which none is
    joined to another is the last. The minimum is aggregated before it is shuffled, and the joins deal a hub's edges
    out over many tasks. Tables are written to the shared folder. Nulls and loops in ``edges`` are ignored; repeated
    edges count once; an empty list gives no row; other columns take no part.
    """
    live = materialise(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct(), "edges")
    labels = None
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("next"))
        step = _roots(materialise(step, "step"))
        if labels is None:
            labels = step.withColumnRenamed("next", "component")
        else:
            moved = step.select(F.col("node").alias("component"), "next")
            labels = spread_join(labels, moved, ["component"], ["node"]).select("node", F.coalesce("next", "component").alias("component"))
            labels = materialise(labels, "labels")
        left = step.select(F.col("node").alias("a"), F.col("next").alias("a2"))
        right = step.select(F.col("node").alias("b"), F.col("next").alias("b2"))
        moved = spread_join(spread_join(live, left, ["a"], ["b"], "inner"), right, ["b"], ["a"], "inner")
        live = materialise(moved.select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b").distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    return labels


def _roots(step: DataFrame) -> DataFrame:
    """(node, next) with each pointer followed to the root of its tree."""
    while True:
        then = step.select(F.col("node").alias("next"), F.col("next").alias("then"))
        jumped = materialise(spread_join(step, then, ["next"], ["node"], "inner").select("node", F.col("then").alias("next"), (F.col("then") != F.col("next")).alias("moved")), "jump")
        step = jumped.select("node", "next")
        if jumped.where("moved").isEmpty():
            return step
