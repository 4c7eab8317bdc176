"""Joins that enrich catalogues, resolve edges and look up ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def listed(rows: DataFrame, key: str, value: str, name: str, separator: str = ",") -> DataFrame:
    """The distinct values of each key in order, joined: aggregated before any join, so keys stay single."""
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), separator).alias(name))


def in_ranges(rows: DataFrame, ranges: DataFrame, value: str, low: str, high: str, bucket: int) -> DataFrame:
    """Rows with the ranges that hold their value, by an equality join on buckets of the value.

    A range is listed under every bucket it touches, which the width of ranges bounds; without the
    bucket the join would compare every row with every range.
    """
    spread = ranges.withColumn("_bucket", F.explode(F.sequence(F.expr(f"{low} div {bucket}"), F.expr(f"{high} div {bucket}"))))
    return rows.withColumn("_bucket", F.expr(f"{value} div {bucket}")).join(spread, "_bucket").where(F.col(value).between(F.col(low), F.col(high))).drop("_bucket")


def first_match(rows: DataFrame, keys: list[str], order: Column, columns: list[str]) -> DataFrame:
    """The first row of each key, combined before the shuffle."""
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_first"))
    return best.select(*keys, *[f"_first.{c}" for c in columns])


def merge_priority(official: DataFrame, prose: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Official values win; prose fills what they leave open."""
    both = official.select(*keys, F.col(value).alias("_a")).join(prose.select(*keys, F.col(value).alias("_b")), keys, "full")
    origin = F.when(F.col("_a").isNotNull(), "official").otherwise("prose")
    return both.select(*keys, F.coalesce("_a", "_b").alias(value), origin.alias("origin"))
