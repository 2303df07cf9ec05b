"""Connected components by contraction, each level a table; hubs are never dealt to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.operators.keyed import lookup_join


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """(node, component) of every node on an edge (a, b); the component is its least node.

    Every node points to its least neighbour (or itself); edges move to the nodes pointed to, and
    those that become loops vanish. When none are left, the pointers are followed back.
    """
    current = steps.keep(edges.select("a", "b").filter("a <> b").distinct())
    levels: list[DataFrame] = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = steps.keep(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"), F.count(F.lit(1)).alias("degree"))
        )
        levels.append(points)
        # A node's degree is as many edges as it can have on either side.
        ends = points.select("a", F.col("to").alias("x"), "degree")
        others = points.select(F.col("a").alias("b"), F.col("to").alias("y"), "degree")
        first = lookup_join(current, ends, "a", "degree").drop("degree")
        moved = (
            lookup_join(first, others, "b", "degree")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        following = steps.keep(moved)
        steps.drop(current)
        current = following
    if not levels:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    result = levels[-1].select(F.col("a").alias("node"), F.col("to").alias("component"))
    for points in reversed(levels[:-1]):
        onward = result.select(F.col("node").alias("to"), F.col("component").alias("end"))
        heads = points.groupBy("to").agg(F.count(F.lit(1)).alias("nodes"))
        followed = steps.keep(heads.join(onward, "to", "left").select("to", "nodes", F.coalesce("end", "to").alias("component")))
        result = lookup_join(points.select("a", "to"), followed, "to", "nodes").select(F.col("a").alias("node"), "component")
    return steps.keep(result)
