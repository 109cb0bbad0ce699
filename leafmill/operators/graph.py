"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.tables import discard, materialize


def relabel(labels: DataFrame, by: DataFrame) -> DataFrame:
    """labels (node, component) with each component replaced by what `by` (node, component) says of it, if anything."""
    newer = by.select(F.col("node").alias("component"), F.col("component").alias("_newer"))
    return labels.join(newer, "component", "left").select("node", F.coalesce("_newer", "component").alias("component"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the least node that is connected with node. Nodes without edges are absent.

    Each round points every node at its least neighbour, doubles the pointers until each ends at a node that points nowhere,
    and contracts the edges along them, so both the doublings and the rounds number about the logarithm of the longest
    path; neither has a limit. Each step is a written table, and a hub of any size costs one aggregation and joins that can
    be split.
    """
    edges = edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).distinct()
    levels = []
    while True:
        edges = materialize(edges)
        if edges.isEmpty():
            break
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        point = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")))
        while not point.join(point.filter("node != component").select(F.col("node").alias("component")), "component", "left_semi").isEmpty():
            longer = materialize(relabel(point, point))  # a pointer to a node that points further on
            discard(point)
            point = longer
        levels.append(point)
        at_u = edges.join(point.select(F.col("node").alias("u"), F.col("component").alias("pu")), "u")
        at_v = at_u.join(point.select(F.col("node").alias("v"), F.col("component").alias("pv")), "v")
        edges = at_v.filter(F.col("pu") != F.col("pv")).select(F.least("pu", "pv").alias("v"), F.greatest("pu", "pv").alias("u")).distinct()
    if not levels:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = levels[-1]
    for point in reversed(levels[:-1]):
        found = relabel(point, found)
    if len(levels) == 1:
        return found
    found = materialize(found)
    discard(*levels)
    return found
