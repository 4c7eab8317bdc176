"""Ordered scans of a chain: compression, diffs, segmentation, folds over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def compress(rows: DataFrame, keys: list[str], order: list, value: str) -> DataFrame:
    """Keep a row where its value differs from the one before it in its chain; gaps do not matter."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    return rows.withColumns({"_before": before, "_first": first}).where(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_before", "_first")


def first_by(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def running(keys: list[str], order: list) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def segment(rows: DataFrame, keys: list[str], order: list, starts: Column) -> DataFrame:
    """Number the segments that begin at rows where ``starts`` holds; 0 for what comes before the first."""
    return rows.withColumn("segment", F.sum(starts.cast("int")).over(running(keys, order)))


def snapshot_numbers(snaps: DataFrame) -> DataFrame:
    """(norm, snap, day, n): the snapshots of each norm in order."""
    own = snaps.select("norm", "snap", "day").distinct()
    return own.withColumn("n", F.row_number().over(Window.partitionBy("norm").orderBy("day", "snap")).cast("bigint"))


def diff(snaps: DataFrame) -> DataFrame:
    """(norm, n, block, change): blocks that a snapshot adds, changes or removes against the one before.

    Each block sends its text to its own snapshot and to the next one, as ``old``; grouping the two
    replaces a full outer self-join, and an aggregation combines before it shuffles.
    """
    numbers = snapshot_numbers(snaps)
    last = numbers.groupBy("norm").agg(F.max("n").alias("last"))
    blocks = snaps.join(numbers.select("norm", "snap", "n"), ["norm", "snap"]).groupBy("norm", "n", "block").agg(F.max("txt").alias("txt"))
    both = blocks.select("norm", "n", "block", F.col("txt").alias("new"), F.lit(None).cast("string").alias("old")).unionByName(
        blocks.select("norm", (F.col("n") + 1).alias("n"), "block", F.lit(None).cast("string").alias("new"), F.col("txt").alias("old")))
    merged = both.groupBy("norm", "n", "block").agg(F.max("new").alias("new"), F.max("old").alias("old")).join(last, "norm").where("n <= last")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return merged.withColumn("change", change).where("change IS NOT NULL").select("norm", "n", "block", "change")
