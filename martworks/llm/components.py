"""Connected components of a graph held in rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _state(edges: DataFrame):
    """Number and order-free checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def contracted(edges: DataFrame) -> DataFrame:
    """One round of contraction: stored edges (a, b) with b < a that join the same nodes, closer to stars.

    Every node hands its neighbours its least one in turn, over larger neighbours and then over smaller ones. All
    steps are grouped minima and joins on the node.
    """
    now = edges.filter("a <> b")
    both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    wide = stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc")
    least = wide.groupBy("a").agg(F.min("b").alias("m"))
    close = wide.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stored(close.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "cc")


def labels(contracted_edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, its least neighbour: nodes of one root belong together, those of different roots may. Nodes
    that are least themselves have no row."""
    return contracted_edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def connected(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with an edge (a, b); both long.

    Contracted until nothing changes: paths halve from round to round, and each component ends as a star. Each round
    is written, so nothing is computed twice.
    """
    now, state = edges, None
    for _ in range(max_rounds):
        now = contracted(now)
        before, state = state, _state(now)
        if state == before or not state[0]:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return stored(now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "cc-roots")
