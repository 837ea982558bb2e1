"""Connected components of a graph whose links are rows, by random contraction.

In every round each node joins the neighbour, or itself, with the smallest hash, and
links move to the joined nodes. A node that nobody chose disappears: a constant
share of the nodes of a path in expectation, so rounds grow with the logarithm of the
longest path; a star of any size takes two rounds, as its node of smallest hash becomes its
centre and then takes all. Links and labels are tables on shared storage between rounds; nothing
but a flag reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component_id) of every node in ``links`` (a, b); the component is its smallest id.

    Links may repeat, point either way and join a node to itself. Nodes without a
    link are not listed.
    """
    edges = scratch.put(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = None
    ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        chosen = both.groupBy(F.col("a").alias("id")).agg(F.min(ranked("b")).alias("m"))
        parent = scratch.put(chosen.select("id", F.least("m", ranked("id"))["n"].alias("to")))
        up = lambda c: parent.select(F.col("id").alias(c), F.col("to").alias(f"p{c}"))  # noqa: E731, B023
        moved = edges.join(up("a"), "a").join(up("b"), "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        fewer = scratch.put(moved.where("a <> b").distinct())
        if labels is None:
            fresh = scratch.put(parent.withColumnRenamed("to", "label"))
        else:
            step = labels.join(parent.withColumnsRenamed({"id": "label"}), "label", "left")
            fresh = scratch.put(step.select("id", F.coalesce("to", "label").alias("label")))
            scratch.drop(labels)
        scratch.drop(parent, edges)
        labels, edges = fresh, fewer
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    least = scratch.put(labels.groupBy("label").agg(F.min("id").alias("component_id")))
    return labels.join(least, "label").select("id", "component_id")
