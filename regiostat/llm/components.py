"""Connected components of a link table, by DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``links(a, b)`` that are not the
    least of their component; the component is its least node.

    Each round every node points to its least neighbour, if that is less
    than itself; chains of pointers are followed to their ends by doubling;
    links between different ends form the next round's, smaller graph (at
    least half of its nodes are gone).  Group sizes never matter: only minima
    per node are aggregated."""
    edges = materialize(_normal(links), "links")
    found = None
    while True:
        up = _ends(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")))
        if found is None:
            found = up
        else:
            over = up.select(F.col("node").alias("component"), F.col("component").alias("root"))
            found = materialize(found.join(over, "component", "left").select("node", F.coalesce("root", "component").alias("component")).unionByName(up), "nodes")
        for end in ("a", "b"):
            edges = edges.join(up.select(F.col("node").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
        edges = materialize(_normal(edges), "links")
        if edges.isEmpty():
            return found


def _normal(links: DataFrame) -> DataFrame:
    return links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _ends(up: DataFrame) -> DataFrame:
    """Pointers ``(node, component)`` followed until they all end at a node
    that points nowhere."""
    up = materialize(up, "pointers")
    while True:
        over = up.select(F.col("node").alias("component"), F.col("component").alias("next"))
        up = materialize(up.join(over, "component", "left").select("node", F.coalesce("next", "component").alias("component"), F.col("next").isNotNull().alias("moved")), "pointers")
        if up.where("moved").isEmpty():
            return up.drop("moved")
        up = up.drop("moved")
