"""Connected components of an edge list, by contraction.

In each round every node hooks onto its smallest smaller neighbour, the resulting trees are
flattened by pointer jumping, and the edges are rewritten to the roots; what is left is a smaller
graph.  All of it is joins and aggregations over (long, long) rows, checkpointed to the shared
folder once a round.  Only row counts come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.llm import store


def _flat(parent: DataFrame) -> DataFrame:
    """Point every node of the forest (node, root) at the root of its tree."""
    while True:
        up = parent.select(F.col("node").alias("via"), F.col("root").alias("above"))
        jumped = parent.join(up, parent["root"] == up["via"], "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        jumped = store.materialise(jumped, "forest")
        parent = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return parent


def _renamed(edges: DataFrame, parent: DataFrame, end: str) -> DataFrame:
    own = parent.select(F.col("node").alias("via"), F.col("root").alias("above"))
    return edges.join(own, edges[end] == own["via"], "left").withColumn(end, F.coalesce("above", end)).drop("via", "above")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), where root is the smallest node it reaches."""
    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = store.materialise(tidy(edges.select("a", "b")), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("root"))
    while not edges.isEmpty():
        parent = _flat(edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"))
        nodes = _renamed(nodes, parent, "root")
        edges = store.materialise(tidy(_renamed(_renamed(edges, parent, "a"), parent, "b")), "edges")
    return nodes


def named_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root, component_id) of all of ``nodes`` (node, least_id).

    ``root`` is the smallest node that one reaches, ``component_id`` the smallest least_id among
    the nodes it reaches; null ids are passed over, and a component of nothing else has the name null.
    """
    found = components(edges).select(F.col("node").alias("of"), "root")
    rooted = store.materialise(nodes.join(found, nodes["node"] == found["of"], "left").select("node", "least_id", F.coalesce("root", "node").alias("root")), "rooted")
    names = store.materialise(rooted.groupBy(F.col("root").alias("by")).agg(F.min("least_id").alias("component_id")), "names")
    return rooted.join(names, rooted["root"] == names["by"]).select("node", "root", "component_id")
