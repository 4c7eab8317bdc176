"""Walks over edge lists: closure, chains, covers.  Levels are joins; only counts reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.session import materialise


def closure(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, node, depth): what each seed reaches over ``edges`` (src, dst), nearest depth first.

    A frontier is joined to the edges and stripped of what the seed has seen already, level by
    level, until none is new, so cycles end; every level is written to the shared folder.
    """
    seen = materialise(seeds.select(F.col("node").alias("seed"), "node", F.lit(0).alias("depth")), "closure")
    frontier, depth = seen, 0
    while True:
        depth += 1
        step = frontier.join(edges, F.col("node") == F.col("src")).select("seed", F.col("dst").alias("node")).distinct()
        frontier = materialise(step.join(seen, ["seed", "node"], "left_anti").withColumn("depth", F.lit(depth)), "closure")
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)


def chain_ends(links: DataFrame) -> DataFrame:
    """(node, first, steps) of linked lists (node, before): the far end of each chain by pointer doubling.

    A chain of n links takes log n joins.  A node on a cycle, or before one, has no end and gets none:
    after so many rounds that a chain of all links would have ended, what still moves is such a node.
    """
    at = materialise(links.select("node", F.col("before").alias("first"), F.lit(1).cast("bigint").alias("steps")), "chain")
    reach, longest = 1, at.count()
    while reach <= longest:
        up = at.select(F.col("node").alias("via"), F.col("first").alias("beyond"), F.col("steps").alias("more"))
        jumped = at.join(up, at["first"] == up["via"], "left")
        at = materialise(jumped.select("node", F.coalesce("beyond", "first").alias("first"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("beyond").isNotNull().alias("moved")), "chain")
        reach *= 2
        if at.where("moved").isEmpty():
            break
        at = at.drop("moved")
    return at.drop("moved").join(links.select(F.col("node").alias("inner")), F.col("first") == F.col("inner"), "left_anti")


def greedy_cover(members: DataFrame) -> list[tuple[str, int]]:
    """The sets (set, item) that cover most, widest first, each with what it adds, until nothing is left.

    One row, the winner, comes to the driver in a round; items stay distributed.
    """
    left, chosen = materialise(members.distinct(), "cover"), []
    while True:
        best = left.groupBy("set").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "set").first()
        if best is None:
            return chosen
        chosen.append((best["set"], best["n"]))
        gone = left.where(F.col("set") == best["set"]).select("item")
        left = materialise(left.join(gone, "item", "left_anti"), "cover")
